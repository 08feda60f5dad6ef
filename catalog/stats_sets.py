"""Aggregates, ordering, set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import RECORDS_SQL, STOP_WORDS, query, records_base, stop_sql, table, topic_sql
from corpusmill.functions.keywords import tokens, top_phrases
from corpusmill.functions.questions import zip_shorter
from corpusmill.functions.relations import merge_relations
from corpusmill.functions.text import is_stop_word
from corpusmill.functions.topics import classify_topic
from corpusmill.operators import ordering as O
from corpusmill.operators import stats as T

_TOPIC, _ = topic_sql("lower(title || chr(10) || content)")


def with_topic(spark, sf):
    return records_base(spark, sf).withColumn("topic", classify_topic(F.col("title"), F.col("content"))["topic"])


@query(
    "progress",
    f"""WITH {RECORDS_SQL}, t AS (SELECT *, {_TOPIC} AS topic, (seq % 7)::INTEGER AS cluster FROM records_base)
    SELECT count(*) AS pages_processed, list_aggregate(list_sort(list(DISTINCT cluster)), 'string_agg', ',') AS clusters,
      list_aggregate(list_sort(list(DISTINCT topic)), 'string_agg', ',') AS topics,
      list_aggregate(list_sort(list(DISTINCT language)), 'string_agg', ',') AS languages,
      0::BIGINT AS duplicates_removed, 0::BIGINT AS invalid_records FROM t""",
)
def progress(spark, sf):
    snap = T.progress(with_topic(spark, sf).withColumn("cluster", (F.col("seq") % 7).cast("int")))
    return snap.select(
        "pages_processed",
        F.array_join(F.transform("clusters", lambda c: c.cast("string")), ",").alias("clusters"),
        F.array_join("topics", ",").alias("topics"),
        F.array_join("languages", ",").alias("languages"),
        "duplicates_removed",
        "invalid_records",
    )


_TOKENS = f"""toks AS (SELECT seq, language, unnest(t) AS w, generate_subscripts(t, 1) AS i
  FROM (SELECT seq, language, regexp_extract_all(lower(content), '[\\p{{L}}\\p{{N}}]+') AS t FROM records_base))"""


@query(
    "keyword_frequency",
    f"""WITH {RECORDS_SQL}, {_TOKENS}, counted AS (SELECT seq, w AS phrase, count(*) AS n, min(i) AS first FROM toks
      WHERE NOT {stop_sql("language", "w")} GROUP BY seq, w)
    SELECT seq, phrase, n, row_number() OVER (PARTITION BY seq ORDER BY n DESC, first) - 1 AS rank FROM counted
    QUALIFY row_number() OVER (PARTITION BY seq ORDER BY n DESC, first) <= 10""",
)
def keyword_frequency(spark, sf):
    words = F.filter(tokens(F.col("content")), lambda w: ~is_stop_word(w, F.col("language"), STOP_WORDS))
    counted = records_base(spark, sf).select("seq", F.posexplode(top_phrases(words)).alias("rank", "e"))
    return counted.select("seq", "e.phrase", F.col("e.count").cast("bigint").alias("n"), F.col("rank").cast("bigint").alias("rank"))


@query(
    "hit_rate",
    """SELECT user_id, count(*) FILTER (event_type = 'view') AS hits, count(*) FILTER (event_type = 'error') AS misses,
      coalesce(count(*) FILTER (event_type = 'view') / nullif(count(*) FILTER (event_type IN ('view', 'error')), 0), 0)::DOUBLE AS hit_rate
    FROM events GROUP BY user_id""",
)
def hit_rate(spark, sf):
    kind = F.col("event_type")
    return T.hit_rate(table(spark, sf, "events"), kind == "view", kind == "error", "user_id")


@query(
    "counters",
    """SELECT event_type, count(*) AS total, round(sum(value), 4) AS seconds, round(avg(value), 6) AS mean_seconds
    FROM events GROUP BY event_type""",
)
def counters(spark, sf):
    return T.counters(table(spark, sf, "events"), "event_type", "value").select(
        "event_type", "total", F.round("seconds", 4).alias("seconds"), F.round("mean_seconds", 6).alias("mean_seconds")
    )


def order_relations(spark, sf):
    items = table(spark, sf, "lineitem")
    return items.select(
        F.concat(F.lit("P"), "l_partkey").alias("subject"),
        F.concat("l_returnflag", "l_linestatus").alias("relation"),
        F.concat(F.lit("S"), "l_suppkey").alias("object"),
        F.struct("l_orderkey", "l_linenumber", "l_extendedprice").alias("seq"),
    )


@query(
    "relation_graph_nodes",
    "SELECT DISTINCT 'P' || l_partkey AS id FROM lineitem UNION SELECT DISTINCT 'S' || l_suppkey FROM lineitem",
)
def graph_nodes(spark, sf):
    return T.relation_graph(order_relations(spark, sf))[0]


@query(
    "relation_graph_edges",
    """SELECT 'P' || l_partkey AS src, 'S' || l_suppkey AS dst,
      arg_max(l_returnflag || l_linestatus, (l_orderkey, l_linenumber, l_extendedprice)) AS relation
    FROM lineitem GROUP BY l_partkey, l_suppkey""",
)
def graph_edges(spark, sf):
    return T.relation_graph(order_relations(spark, sf))[1]


@query(
    "top_n_per_group",
    """SELECT c_nationkey, c_custkey, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) AS rank
    FROM customer QUALIFY row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) <= 10""",
)
def top_n(spark, sf):
    return O.top_n(table(spark, sf, "customer"), ["c_nationkey"], [F.desc("c_acctbal"), "c_custkey"], 10).select(
        "c_nationkey", "c_custkey", "rank"
    )


@query(
    "page_cap",
    """SELECT l_returnflag, l_orderkey, l_linenumber, l_partkey FROM lineitem
    QUALIFY row_number() OVER (PARTITION BY l_returnflag ORDER BY l_orderkey, l_linenumber, l_partkey, l_extendedprice) <= 1000""",
)
def page_cap(spark, sf):
    order = ["l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice"]
    return O.top_n(table(spark, sf, "lineitem"), ["l_returnflag"], order, 1000).select(
        "l_returnflag", "l_orderkey", "l_linenumber", "l_partkey"
    )


@query(
    "final_sort",
    f"""WITH {RECORDS_SQL}, t AS (SELECT *, {_TOPIC} AS topic FROM records_base)
    SELECT seq, language, topic FROM t ORDER BY language, topic, seq""",
)
def final_sort(spark, sf):
    return O.final_sort(with_topic(spark, sf)).select("seq", "language", "topic")


@query(
    "positional_caps",
    r"""SELECT doc_id, list_aggregate(list_slice(string_split_regex(text, '\s+'), 1, 5), 'string_agg', ' ') AS first_words,
      length(substr(text, 1, 10000)) AS kept, md5(substr(text, 1, 10000)) AS head FROM documents""",
)
def positional_caps(spark, sf):
    from corpusmill.constants import MAX_TEXT_LENGTH

    head = F.substring("text", 1, MAX_TEXT_LENGTH)
    return table(spark, sf, "documents").select(
        "doc_id",
        F.array_join(F.slice(F.split("text", r"\s+"), 1, 5), " ").alias("first_words"),
        F.length(head).alias("kept"),
        F.md5(head).alias("head"),
    )


@query(
    "positional_zip",
    r"""WITH l AS (SELECT doc_id, string_split(text, chr(10)) AS a, list_slice(string_split_regex(text, '\s+'), 1, 4) AS b FROM documents)
    SELECT doc_id, i - 1 AS pos, a[i] AS left_item, b[i] AS right_item
    FROM (SELECT *, unnest(generate_series(1, least(len(a), len(b)))) AS i FROM l)""",
)
def positional_zip(spark, sf):
    pairs = zip_shorter(F.split("text", "\n"), F.slice(F.split("text", r"\s+"), 1, 4), "left_item", "right_item")
    rows = table(spark, sf, "documents").select("doc_id", F.posexplode(pairs).alias("pos", "p"))
    return rows.select("doc_id", "pos", "p.left_item", "p.right_item")


@query(
    "union_all_sources",
    """SELECT 'supplier' AS kind, s_suppkey AS key, s_name AS title, s_acctbal AS balance, NULL::VARCHAR AS segment FROM supplier
    UNION ALL SELECT 'customer', c_custkey, c_name, c_acctbal, c_mktsegment FROM customer""",
)
def union_all(spark, sf):
    suppliers = table(spark, sf, "supplier").select(
        F.lit("supplier").alias("kind"), F.col("s_suppkey").alias("key"), F.col("s_name").alias("title"),
        F.col("s_acctbal").alias("balance"),
    )
    customers = table(spark, sf, "customer").select(
        F.lit("customer").alias("kind"), F.col("c_custkey").alias("key"), F.col("c_name").alias("title"),
        F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"),
    )
    return suppliers.unionByName(customers, allowMissingColumns=True)


@query(
    "merge_relations",
    """SELECT p_partkey, pos, subject, relation, object FROM part, (VALUES
        (0, 'A', 'worked at', 'B'), (1, 'A', 'worked at', 'B'), (2, 'C', 'discovered', 'x'), (3, 'D', 'studied at', 'E')
      ) v(pos, subject, relation, object_) , LATERAL (SELECT CASE WHEN pos = 2 THEN p_brand ELSE object_ END AS object)""",
)
def merge(spark, sf):
    def rel(s, r, o):
        return F.struct(F.lit(s).alias("subject"), F.lit(r).alias("relation"), o.alias("object"))

    first = F.array(rel("A", "worked at", F.lit("B")), rel("A", "worked at", F.lit("B")), rel("C", "discovered", F.col("p_brand")))
    second = F.array(
        rel("D", "studied at", F.lit("E")), rel("A", "worked at", F.lit("B")), rel("D", "studied at", F.lit("E")),
        rel("C", "discovered", F.col("p_brand")),
    )
    rows = table(spark, sf, "part").select("p_partkey", F.posexplode(merge_relations(first, second)).alias("pos", "r"))
    return rows.select("p_partkey", "pos", "r.subject", "r.relation", "r.object")


@query(
    "distinct_values",
    """SELECT lang, list_aggregate(list_sort(list(DISTINCT source)), 'string_agg', ',') AS sources FROM documents GROUP BY lang""",
)
def distinct_values(spark, sf):
    return table(spark, sf, "documents").groupBy("lang").agg(
        F.array_join(F.sort_array(F.collect_set("source")), ",").alias("sources")
    )
