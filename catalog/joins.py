"""Joins, gap filling and walks."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import RECORDS_SQL, query, records_base, table
from corpusmill.constants import MAX_PAGES, NS_CATEGORY, NS_MAIN
from corpusmill.operators import quality as Q
from corpusmill.operators.categories import work_grid
from corpusmill.operators.fill import complete_missing_fields, last_good, unexpired
from corpusmill.operators.walks import category_members, crawl_links


@query(
    "complete_missing_fields",
    f"""WITH {RECORDS_SQL}, ours AS (SELECT seq, title, CASE WHEN length(content) < 100 THEN NULL ELSE language END AS language,
        CASE WHEN length(content) < 400 THEN '' ELSE category END AS category, 0 AS score,
        CASE WHEN language = 'fr' THEN '' ELSE 'base' END AS source FROM records_base),
      extra AS (SELECT 'doc ' || doc_id AS title, CASE WHEN quality = 1 THEN 'en' END AS language,
          'quality ' || quality AS category, quality + 5 AS score, 'extra' AS source, 'Q' || doc_id AS wikidata_id, doc_id AS extra_seq FROM labels
        UNION ALL SELECT 'doc ' || doc_id, 'en', 'toxic', 9, 'late', 'T' || doc_id, doc_id + 1000000 FROM labels WHERE toxic = 1),
      last AS (SELECT * FROM extra QUALIFY row_number() OVER (PARTITION BY title, language ORDER BY extra_seq DESC) = 1)
    SELECT o.seq, CASE WHEN o.category = '' THEN coalesce(l.category, o.category) ELSE o.category END AS category, o.score,
      CASE WHEN o.source = '' THEN coalesce(l.source, o.source) ELSE o.source END AS source, l.wikidata_id
    FROM ours o LEFT JOIN last l ON o.title = l.title AND o.language IS NOT DISTINCT FROM l.language""",
)
def complete(spark, sf):
    base = records_base(spark, sf)
    ours = base.select(
        "seq",
        "title",
        F.when(F.length("content") >= 100, F.col("language")).alias("language"),
        F.when(F.length("content") < 400, "").otherwise(F.col("category")).alias("category"),
        F.lit(0).alias("score"),
        F.struct(F.when(F.col("language") == "fr", "").otherwise("base").alias("source")).alias("metadata"),
    )
    labels = table(spark, sf, "labels")
    title = F.concat(F.lit("doc "), "doc_id").alias("title")
    first = labels.select(
        title, F.when(F.col("quality") == 1, "en").alias("language"),
        F.concat(F.lit("quality "), "quality").alias("category"), (F.col("quality") + 5).alias("score"),
        F.struct(F.lit("extra").alias("source")).alias("metadata"),
        F.concat(F.lit("Q"), "doc_id").alias("wikidata_id"), F.col("doc_id").alias("extra_seq"),
    )
    late = labels.filter("toxic = 1").select(
        title, F.lit("en").alias("language"), F.lit("toxic").alias("category"), F.lit(9).alias("score"),
        F.struct(F.lit("late").alias("source")).alias("metadata"),
        F.concat(F.lit("T"), "doc_id").alias("wikidata_id"), (F.col("doc_id") + 1000000).alias("extra_seq"),
    )
    filled = complete_missing_fields(ours, first.unionByName(late))
    return filled.select("seq", "category", "score", "metadata.source", "wikidata_id")


_ALL_LANGS = ["en", "fr", "de", "es"]
_ALL_CATEGORIES = ["programacao", "DevOps", "src0"]


def source_jobs(spark, sf):
    """One job per source: its languages (null for frequent sources) and itself as category (null for src1)."""
    docs = table(spark, sf, "documents")
    by_source = docs.groupBy("source").agg(F.collect_set("lang").alias("langs"), F.count(F.lit(1)).alias("n"))
    return by_source.select(
        F.when(F.col("source") != "src2", F.col("langs")).alias("lang"),
        F.when(F.col("source") != "src1", F.array("source")).alias("category"),
        F.col("source").alias("format"),
    )


_GRID_SQL = """WITH jobs AS (SELECT DISTINCT source, lang FROM documents WHERE source <> 'src2'
      UNION ALL SELECT DISTINCT source, unnest(['en', 'fr', 'de', 'es']) FROM (SELECT DISTINCT source FROM documents WHERE source = 'src2'))
    SELECT source AS format, lang, source AS category, 1.0::DOUBLE AS weight FROM jobs WHERE source <> 'src1'
    UNION ALL SELECT source, lang, unnest(['Programação', 'DevOps', 'src0']), 1.0::DOUBLE FROM jobs WHERE source = 'src1'"""


@query("work_grid", _GRID_SQL)
def grid(spark, sf):
    return work_grid(source_jobs(spark, sf), _ALL_LANGS, _ALL_CATEGORIES)


def membership(spark, sf):
    """region -> nation (categories) -> customer (pages)."""
    region, nation, customer = (table(spark, sf, t) for t in ("region", "nation", "customer"))
    subs = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("r_name").alias("parent"), F.concat(F.lit("Category:"), "n_name").alias("member"),
        F.lit(NS_CATEGORY).alias("ns"), F.concat(F.lit("/wiki/"), "n_name").alias("url"),
        F.col("n_nationkey").cast("int").alias("pos"),
    )
    leaves = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("n_name").alias("parent"), F.col("c_name").alias("member"), F.lit(NS_MAIN).alias("ns"),
        F.concat(F.lit("/wiki/"), "c_name").alias("url"), F.col("c_custkey").cast("int").alias("pos"),
    )
    return subs.unionByName(leaves)


_MEMBERSHIP = """membership AS (
  SELECT r_name AS parent, 'Category:' || n_name AS member, 14 AS ns, '/wiki/' || n_name AS url, n_nationkey::INTEGER AS pos
  FROM nation JOIN region ON n_regionkey = r_regionkey
  UNION ALL SELECT n_name, c_name, 0, '/wiki/' || c_name, c_custkey::INTEGER FROM customer JOIN nation ON c_nationkey = n_nationkey)"""


@query("category_membership", f"WITH {_MEMBERSHIP} SELECT * FROM membership")
def membership_scan(spark, sf):
    return membership(spark, sf)


@query("namespace_main", f"WITH {_MEMBERSHIP} SELECT parent, member FROM membership WHERE ns = 0")
def namespace_main(spark, sf):
    return Q.main_pages(membership(spark, sf)).select("parent", "member")


@query("namespace_category", f"WITH {_MEMBERSHIP} SELECT parent, member FROM membership WHERE ns = 14")
def namespace_category(spark, sf):
    return Q.category_pages(membership(spark, sf)).select("parent", "member")


_MEMBERS_SQL = f"""WITH RECURSIVE {_MEMBERSHIP}, walk AS (
      SELECT r_name AS root, r_name AS category, 0 AS depth, member, ns, url, [pos] AS path FROM region JOIN membership ON parent = r_name
      UNION ALL SELECT root, m.parent, depth + 1, m.member, m.ns, m.url, list_append(path, m.pos)
      FROM walk w JOIN membership m ON m.parent = replace(w.member, 'Category:', '') WHERE w.ns = 14 AND w.depth < 3),
    pages AS (SELECT *, row_number() OVER (PARTITION BY root ORDER BY path) AS rank FROM walk WHERE ns = 0)
    SELECT root, member AS title, url, category, depth FROM pages"""


@query("category_members", _MEMBERS_SQL)
def members(spark, sf, cap=None):
    roots = table(spark, sf, "region").select(F.col("r_name").alias("root"))
    return category_members(membership(spark, sf), roots, cap=cap).drop("path")


@query("category_members_capped", f"{_MEMBERS_SQL} WHERE rank <= {MAX_PAGES}")
def members_capped(spark, sf):
    return members(spark, sf, MAX_PAGES)


def order_part_links(spark, sf):
    """Orders link to their parts and parts to their orders."""
    pairs = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey").distinct()
    order, part = F.concat(F.lit("Order "), "l_orderkey"), F.concat(F.lit("Part "), "l_partkey")

    def link(src, pos, dst):
        return F.struct(
            src.alias("src"), F.col(pos).cast("int").alias("pos"),
            F.concat(F.lit("/wiki/"), F.replace(dst, F.lit(" "), F.lit("_"))).alias("url"), dst.alias("dst"),
        )

    both = F.array(link(order, "l_partkey", part), link(part, "l_orderkey", order))
    return pairs.select(F.explode(both).alias("l")).select("l.*")


def dearest_orders(spark, sf):
    """The order with the highest price of each priority."""
    return table(spark, sf, "orders").groupBy("o_orderpriority").agg(
        F.max_by("o_orderkey", F.struct("o_totalprice", "o_orderkey")).alias("k")
    ).select(F.concat(F.lit("Order "), "k").alias("start"))


_CRAWL_SQL = """WITH pairs AS (SELECT DISTINCT l_orderkey AS o, l_partkey AS p FROM lineitem),
    starts AS (SELECT arg_max(o_orderkey, (o_totalprice, o_orderkey)) AS s FROM orders GROUP BY o_orderpriority),
    emitted AS (SELECT s, 'Part ' || p AS title, 0 AS depth, 0 AS first, p AS second FROM starts JOIN pairs ON o = s
      UNION ALL SELECT s, 'Order ' || b.o, 1, a.p, b.o FROM starts JOIN pairs a ON a.o = s JOIN pairs b ON b.p = a.p AND b.o <> s),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY s ORDER BY depth, first, second) AS rank FROM emitted)
    SELECT 'Order ' || s AS category, title, '/wiki/' || replace(title, ' ', '_') AS url, depth FROM ranked"""


@query("crawl_links", _CRAWL_SQL)
def crawl(spark, sf, cap=None):
    rows = crawl_links(order_part_links(spark, sf), dearest_orders(spark, sf), depth=1, cap=cap)
    return rows.select(F.col("start").alias("category"), "title", "url", "depth")


@query("crawl_links_capped", f"{_CRAWL_SQL} WHERE rank <= {MAX_PAGES}")
def crawl_capped(spark, sf):
    return crawl(spark, sf, MAX_PAGES)


@query(
    "crawl_links_uncapped",
    """WITH pairs AS (SELECT DISTINCT l_orderkey AS o, l_partkey AS p FROM lineitem),
    starts AS (SELECT arg_max(o_orderkey, (o_totalprice, o_orderkey)) AS s FROM orders GROUP BY o_orderpriority),
    l1 AS (SELECT s, p, [p] AS path FROM starts JOIN pairs ON o = s),
    l2 AS (SELECT s, b.o, min([l1.p, b.o]) AS path FROM l1 JOIN pairs b ON b.p = l1.p WHERE b.o <> s GROUP BY s, b.o),
    emitted AS (SELECT s, 'Part ' || p AS title, 0 AS depth FROM l1
      UNION ALL SELECT l1.s, 'Order ' || b.o, 1 FROM l1 JOIN pairs b ON b.p = l1.p WHERE b.o <> l1.s
      UNION ALL SELECT l2.s, 'Part ' || b.p, 2 FROM l2 JOIN pairs b ON b.o = l2.o
        WHERE NOT EXISTS (SELECT 1 FROM l1 WHERE l1.s = l2.s AND l1.p = b.p))
    SELECT 'Order ' || s AS category, title, depth, count(*) AS times FROM emitted GROUP BY ALL""",
)
def crawl_uncapped(spark, sf):
    rows = crawl_links(order_part_links(spark, sf), dearest_orders(spark, sf), depth=2, cap=None)
    return rows.groupBy(F.col("start").alias("category"), "title", "depth").agg(F.count(F.lit(1)).alias("times"))


def snapshots(spark, sf):
    ts = F.col("ts").cast("timestamp")
    return table(spark, sf, "events").select(
        F.col("user_id").alias("key"), F.col("event_id").cast("string").alias("value"),
        F.struct(ts, "event_id").alias("fetched_at"),
        F.when(F.col("event_type") != "purchase", ts + F.expr("INTERVAL 3 DAYS")).alias("expires_at"),
        "event_type",
    )


_SNAPSHOTS = """snapshots AS (SELECT user_id AS key, event_id::VARCHAR AS value, ts, event_id, event_type,
  CASE WHEN event_type <> 'purchase' THEN ts + INTERVAL 3 DAY END AS expires_at FROM events)"""


@query(
    "last_good_value",
    f"""WITH {_SNAPSHOTS}, live AS (SELECT key, arg_max(value, (ts, event_id)) AS stored FROM snapshots
        WHERE expires_at IS NULL OR expires_at >= TIMESTAMP '2024-01-29 00:00:00' GROUP BY key),
      fresh AS (SELECT user_id AS key, max(CASE WHEN value > 80 THEN 'fresh ' || user_id END) AS fresh FROM events GROUP BY user_id)
    SELECT key, coalesce(fresh, stored, '') AS value FROM fresh LEFT JOIN live USING (key)""",
)
def last_good_value(spark, sf):
    events = table(spark, sf, "events")
    requests = events.groupBy(F.col("user_id").alias("key")).agg(
        F.max(F.when(F.col("value") > 80, F.concat(F.lit("fresh "), "user_id"))).alias("fresh")
    )
    return last_good(requests, snapshots(spark, sf), "2024-01-29 00:00:00")


@query(
    "purge_expired",
    f"""WITH {_SNAPSHOTS} SELECT key, value FROM snapshots WHERE expires_at IS NULL OR expires_at >= TIMESTAMP '2024-01-29 00:00:00'""",
)
def purge(spark, sf):
    return unexpired(snapshots(spark, sf), "2024-01-29 00:00:00").select("key", "value")
