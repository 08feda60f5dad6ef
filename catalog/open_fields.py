"""Records with unknown fields: read, written and read again."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import RECORDS_SQL, query, records_base, table
from corpusmill.session import new_path
from corpusmill.sources.open_records import read_open_records, write_open_records


@query(
    "scan_records_open",
    f"""WITH {RECORDS_SQL} SELECT r.id, r.title, r.content, d.n_chars::BIGINT AS n_chars, d.source AS origin, CASE WHEN d.doc_id % 3 = 0 THEN d.lang END AS second_tag
    FROM records_base r JOIN documents d ON d.doc_id = r.seq""",
)
def open_records(spark, sf):
    more = table(spark, sf, "documents").select(F.col("doc_id").alias("seq"), "n_chars", "source", "lang")
    tags = F.when(F.col("seq") % 3 == 0, F.array(F.lit("a"), F.col("lang"))).otherwise(F.array(F.lit("a")))
    odd = records_base(spark, sf).select("seq", "id", "title", "content").join(more, "seq").select(
        "id", "title", "content", "n_chars", F.struct("source", tags.alias("tags")).alias("origin")
    )
    first, second = new_path(spark, "open"), new_path(spark, "open")
    odd.write.json(first)
    write_open_records(read_open_records(spark, first), second)
    back = read_open_records(spark, second)
    field = lambda at, kind: F.variant_get("extra", at, kind)
    return back.select(
        "id", "title", "content", field("$.n_chars", "bigint").alias("n_chars"),
        field("$.origin.source", "string").alias("origin"), field("$.origin.tags[1]", "string").alias("second_tag"),
    )
