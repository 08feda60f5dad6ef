"""Scans, payloads, named sources and sinks. Sinks write to the shared folder and the result is read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import RECORDS_SQL, STOP_WORDS, clean_sql, pages, query, record_text_sql, records_base, table
from catalog.corpus import with_questions
from catalog.html_jobs import marked_pages
from catalog.joins import _GRID_SQL, _ALL_CATEGORIES, _ALL_LANGS, source_jobs
from catalog.records import page_texts
from corpusmill.constants import PAYLOAD_LIMIT
from corpusmill.operators.categories import work_grid
from corpusmill.operators.stats import progress
from corpusmill.plans.records import build_records, quality_pass, run_source, training_bundle
from corpusmill.session import new_path
from corpusmill.sinks import writers as W
from corpusmill.sources import payloads as P
from corpusmill.sources.registry import register_payload_sources, union_sources
from corpusmill.sources.tables import read_jobs, read_records, read_url_list

_PLAIN = f"WITH {RECORDS_SQL} SELECT id, title, language, category, content, strftime(created_at, '%Y-%m-%d %H:%M:%S') AS created_at FROM records_base"


def _plain(df):
    return df.select(
        "id", "title", "language", "category", "content",
        F.date_format(F.col("created_at").cast("timestamp"), "yyyy-MM-dd HH:mm:ss").alias("created_at"),
    )


@query("scan_records_json", _PLAIN)
def scan_records(spark, sf):
    path = new_path(spark, "records")
    W.write_dataset(records_base(spark, sf), path, "jsonl")
    return _plain(read_records(spark, f"{path}/jsonl", lines=True))


@query("sink_csv", f"WITH {RECORDS_SQL} SELECT seq, title, content, to_json([language, category])::VARCHAR AS tags FROM records_base")
def sink_csv(spark, sf):
    path = new_path(spark, "csv")
    tagged = records_base(spark, sf).select("seq", "title", "content", F.array("language", "category").alias("tags"))
    W.write_dataset(tagged, path, "csv")
    return spark.read.schema("seq bigint, title string, content string, tags string").option("header", True).option(
        "escape", '"'
    ).option("multiLine", True).csv(f"{path}/csv")


@query("sink_parquet", _PLAIN)
def sink_parquet(spark, sf):
    path = new_path(spark, "parquet")
    W.write_dataset(records_base(spark, sf), path, "parquet")
    return _plain(spark.read.parquet(f"{path}/parquet"))


@query(
    "sink_all_formats",
    "SELECT unnest(['json', 'jsonl', 'csv', 'parquet']) AS format, count(*) AS n FROM customer",
)
def sink_all(spark, sf):
    path = new_path(spark, "all")
    customers = table(spark, sf, "customer")
    targets = W.write_dataset(customers, path, "all")
    out = None
    for name, target in zip(W.DATASET_FORMATS, targets):
        reader = {"csv": spark.read.option("header", True).csv, "parquet": spark.read.parquet}.get(name, spark.read.json)
        part = reader(target).agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("format"), "n")
        out = part if out is None else out.unionByName(part)
    return out


@query("sink_pages", "SELECT url, html FROM pages")
def sink_pages(spark, sf):
    path = new_path(spark, "pages")
    return spark.read.schema("url string, html string").json(W.export_pages(pages(spark, sf), path, "json")[0])


@query("text_corpus", f"WITH {RECORDS_SQL} SELECT id AS name, {clean_sql('content')} AS text FROM records_base")
def text_corpus(spark, sf):
    return W.text_corpus(records_base(spark, sf))


@query("json_rows", "SELECT to_json({'s_suppkey': s_suppkey, 's_name': s_name, 's_nationkey': s_nationkey})::VARCHAR AS data FROM supplier")
def json_rows(spark, sf):
    return W.json_rows(table(spark, sf, "supplier").select("s_suppkey", "s_name", "s_nationkey"))


_BLOB = "to_json({'id': id, 'metadata': {'length': length(content), 'source': category}})::VARCHAR"


@query("json_blobs", f"WITH {RECORDS_SQL} SELECT md5({_BLOB}) AS key, {_BLOB} AS data FROM records_base")
def json_blobs(spark, sf):
    path = new_path(spark, "blobs")
    meta = F.struct(F.length("content").alias("length"), F.col("category").alias("source"))
    W.append_blobs(records_base(spark, sf).withColumn("metadata", meta), path)
    return spark.read.parquet(path)


@query(
    "sink_progress",
    f"""WITH {RECORDS_SQL} SELECT count(*) AS pages_processed,
      list_aggregate(list_sort(list(DISTINCT language)), 'string_agg', ',') AS languages FROM records_base""",
)
def sink_progress(spark, sf):
    path = new_path(spark, "progress")
    W.write_progress(progress(records_base(spark, sf)), path)
    snap = W.read_progress(spark, path, "pages_processed bigint, languages array<string>")
    return snap.select("pages_processed", F.array_join("languages", ",").alias("languages"))


@query(
    "training_bundle",
    r"""WITH n AS (SELECT least(1 + 3 * least(len(string_split_regex(text, '\s+')), 7) + 1,
        2 + len(list_filter(string_split(text, chr(10)), lambda p: trim(p) <> ''))) AS pairs,
        least(len(string_split_regex(text, '\s+')), 7) AS words FROM documents)
    SELECT 'pairs' AS part, sum(pairs)::BIGINT AS n FROM n UNION ALL SELECT 'embeddings', count(*) FROM n
    UNION ALL SELECT 'triples', sum(words)::BIGINT FROM n""",
)
def bundle(spark, sf):
    path = new_path(spark, "bundle") + ".json"
    with_questions(spark, sf).drop("words").write.json(path)  # not a field of records
    out = None
    for name, target in training_bundle(spark, path, lines=True).items():
        part = spark.read.text(target).agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("part"), "n")
        out = part if out is None else out.unionByName(part)
    return out


@query(
    "scan_url_list",
    r"""SELECT url, split_part(regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1), '/', -1) AS title,
      split_part(regexp_extract(url, '^[a-z]+://([^/?#:]*)', 1), '.', 1) AS lang FROM pages""",
)
def url_list(spark, sf):
    path = new_path(spark, "urls")
    lines = table(spark, sf, "pages").select(F.explode(F.array(F.concat(F.lit("  "), "url", F.lit(" ")), F.lit("  "))).alias("value"))
    lines.write.text(path)
    return read_url_list(spark, path, "/")


@query("scan_jobs", _GRID_SQL)
def jobs(spark, sf):
    path = new_path(spark, "jobs")
    source_jobs(spark, sf).write.json(path)
    return work_grid(read_jobs(spark, path), _ALL_LANGS, _ALL_CATEGORIES)


def qa_payloads(spark, sf):
    """One landed answer of a question site per document."""
    body = F.concat(F.lit("<p>"), "text", F.lit("</p>"))
    item = F.struct(
        F.concat(F.lit("Q"), "doc_id").alias("title"), body.alias("body"), F.col("n_chars").alias("score"),
        F.concat(F.lit("q/"), F.lpad(F.col("doc_id").cast("string"), 9, "0")).alias("link"),
    )
    return table(spark, sf, "documents").select("lang", F.col("source").alias("category"), F.array(item).alias("items"))


_QA_SQL = f"""SELECT 'Q' || doc_id AS title, lang AS language, source AS category, n_chars AS score,
      'q/' || lpad(doc_id::VARCHAR, 9, '0') AS link, {record_text_sql("text", "lang")} AS content FROM documents"""


@query("qa_site_items", _QA_SQL)
def qa_items(spark, sf):
    return P.parse_qa_items(P.qa_items(qa_payloads(spark, sf)))


@query(
    "qa_site_items_top",
    f"{_QA_SQL} QUALIFY row_number() OVER (PARTITION BY lang, source ORDER BY n_chars DESC, doc_id) <= {PAYLOAD_LIMIT}",
)
def qa_items_top(spark, sf):
    return P.parse_qa_items(P.qa_items(qa_payloads(spark, sf), PAYLOAD_LIMIT))


def entity_payloads(spark, sf):
    """Landed entity searches and details: one pair per customer; debtors have no image, some no label."""
    qid = F.concat(F.lit("Q"), "c_custkey")
    lang = F.when(F.col("c_acctbal") > 5000, "pt").otherwise("en")
    value = lambda c: F.struct(c.alias("value"))
    mainsnak = F.struct(F.struct(value(F.concat("c_name", F.lit(".jpg"))).alias("datavalue")).alias("mainsnak"))
    entity = F.struct(
        F.create_map(F.lit("en"), value(F.concat(F.lit("Label "), "c_name"))).alias("labels"),
        F.create_map(F.lit("pt"), value(F.concat(F.lit("Texto "), "c_name"))).alias("descriptions"),
        F.map_filter(
            F.create_map(F.when(F.col("c_acctbal") >= 0, "P18").otherwise("P1"), F.array(mainsnak)), lambda k, v: k.isNotNull()
        ).alias("claims"),
    )
    customers = table(spark, sf, "customer")
    search = F.array(F.struct(qid.alias("id"), F.col("c_name").alias("label"), F.lit("hit").alias("description")))
    return customers.select(
        lang.alias("lang"), F.col("c_mktsegment").alias("category"), search.alias("search"),
        F.create_map(qid, entity).alias("entities"),
    )


_ENTITY_SQL = """SELECT CASE WHEN c_acctbal > 5000 THEN c_name ELSE 'Label ' || c_name END AS title,
      CASE WHEN c_acctbal > 5000 THEN 'pt' ELSE 'en' END AS language, c_mktsegment AS category,
      CASE WHEN c_acctbal > 5000 THEN 'Texto ' || c_name ELSE 'hit' END AS description, 'Q' || c_custkey AS wikidata_id,
      CASE WHEN c_acctbal >= 0 THEN 'https://commons.wikimedia.org/wiki/Special:FilePath/' || c_name || '.jpg' END AS image_url
    FROM customer"""


@query("entity_items", _ENTITY_SQL)
def entity_items(spark, sf):
    payloads = entity_payloads(spark, sf)
    return P.parse_entity_items(P.entity_items(payloads), P.entity_details(payloads))


@query(
    "revision_history",
    """SELECT conv_id, turn, i - 1 AS pos, 't' || i AS timestamp, role AS user FROM (SELECT *, unnest(generate_series(1, turn + 1)) AS i
      FROM conversations)""",
)
def revision_history(spark, sf):
    revs = F.transform(
        F.sequence(F.lit(1), (F.col("turn") + 1).cast("int")),
        lambda i: F.struct(F.concat(F.lit("t"), i).alias("timestamp"), F.col("role").alias("user")),
    )
    page = F.create_map(F.concat(F.lit("p"), "turn"), F.struct(revs.alias("revisions")))
    payload = F.to_json(F.struct(F.struct(page.alias("pages")).alias("query")))
    rows = table(spark, sf, "conversations").select(F.struct("conv_id", "turn").alias("k"), payload.alias("payload"))
    flat = P.revisions(rows, "k").select("k.conv_id", "k.turn", F.posexplode("revisions").alias("pos", "r"))
    return flat.select("conv_id", "turn", "pos", "r.timestamp", "r.user")


@query(
    "related_pages",
    """SELECT 'en' AS lang, o_orderkey || '-' || i AS title FROM (SELECT o_orderkey, unnest([3, 6, 9, 12]) AS i FROM orders)""",
)
def related(spark, sf):
    links = F.transform(
        F.sequence(F.lit(1), F.lit(14)),
        lambda i: F.struct(
            F.when(i % 3 == 0, 0).otherwise(14).alias("ns"), F.concat(F.col("o_orderkey"), F.lit("-"), i).alias("title")
        ),
    )
    page = F.create_map(F.col("o_orderkey").cast("string"), F.struct(links.alias("links")))
    payload = F.to_json(F.struct(F.struct(page.alias("pages")).alias("query")))
    return P.related_pages(table(spark, sf, "orders").select(F.lit("en").alias("lang"), payload.alias("payload")))


@query(
    "union_sources",
    """SELECT kind, count(*) AS n FROM (SELECT 'entity' AS kind FROM customer WHERE c_mktsegment IN (SELECT DISTINCT c_mktsegment FROM customer)
      UNION ALL SELECT unnest(['infobox', 'tables']) FROM pages) GROUP BY kind""",
)
def all_sources(spark, sf):
    segments = F.array(*[F.lit(s) for s in ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")])
    listed = marked_pages(spark, sf).withColumn("category", F.element_at(segments, (F.length("html") % 5 + 1).cast("int")))
    register_payload_sources(qa_payloads(spark, sf), entity_payloads(spark, sf), listed)
    categories = table(spark, sf, "customer").select(F.col("c_mktsegment").alias("category")).distinct()
    grid = work_grid(categories.select(F.lit(None).cast("array<string>").alias("lang"), F.array("category").alias("category")), ["en", "pt"])
    rows = union_sources(spark, ["qa", "entities", "infobox", "tables"], grid)
    kind = F.when(F.col("infobox").isNotNull(), "infobox").when(F.col("tables").isNotNull(), "tables").otherwise("entity")
    return rows.groupBy(kind.alias("kind")).agg(F.count(F.lit(1)).alias("n"))


@query("run_source", _ENTITY_SQL)
def run_named_source(spark, sf):
    register_payload_sources(entities=entity_payloads(spark, sf))
    path = new_path(spark, "source")
    categories = table(spark, sf, "customer").select(F.col("c_mktsegment").alias("category")).distinct()
    jobs_all = categories.select(F.array(F.lit("en"), F.lit("pt")).alias("lang"), F.array("category").alias("category"))
    run_source(spark, "entities", work_grid(jobs_all), path, "parquet")
    return spark.read.parquet(f"{path}/parquet")


@query("quality_pass")
def whole_quality_pass(spark, sf):
    result = quality_pass(build_records(page_texts(spark, sf), STOP_WORDS))
    return result.accounting


@query(
    "build_dataset",
    f"""WITH {RECORDS_SQL}, c AS (SELECT {record_text_sql('content', 'language')} AS content, language FROM records_base)
    SELECT language, count(*) AS n, sum(length(content))::BIGINT AS characters FROM c WHERE length(content) >= 150 GROUP BY language""",
)
def build_dataset(spark, sf):
    records = build_records(page_texts(spark, sf), STOP_WORDS)
    return records.groupBy("language").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("content")).alias("characters"))


