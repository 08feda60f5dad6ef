"""Records with fields that the schema does not know: kept as one VARIANT column and written back unchanged."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from corpusmill.schema import RECORD_DDL
from corpusmill.sinks.writers import KEEP_NULLS
from corpusmill.sources.tables import record_lists, RAW_RECORD_DDL

_FIELDS = "map<string,variant>"


def _without(fields: Column, names: list[str]) -> Column:
    return F.map_filter(fields, lambda k, _: ~k.isin(names))


def read_open_records(spark: SparkSession, path: str, extra: str = "extra") -> DataFrame:
    """Records of JSON lines, with all other top-level fields of a line in the VARIANT column ``extra``.

    ``extra`` is null for a line without such fields and for one that is not a JSON object; the latter has null fields, as Spark's reader gives them.
    Files are split by line. Numbers, texts, lists and objects in ``extra`` keep their JSON types, so nothing has to be declared for them.
    """
    known = StructType.fromDDL(RECORD_DDL).names
    lines = spark.read.text(path).filter(F.trim("value") != "")
    parsed = F.try_parse_json("value")
    fields = F.when(F.schema_of_variant(parsed).startswith("OBJECT"), parsed).cast(_FIELDS)
    rows = lines.select(F.from_json("value", RAW_RECORD_DDL).alias("r"), _without(fields, known).alias("m"))
    return record_lists(rows.select("r.*", F.when(F.size("m") > 0, F.to_variant_object("m")).alias(extra)))


def write_open_records(records: DataFrame, path: str, extra: str = "extra", mode: str = "error") -> str:
    """Write JSON lines in which the fields of ``extra`` stand beside the others again. A column wins over a field of its name."""
    own = [c for c in records.columns if c != extra]
    columns = F.parse_json(F.to_json(F.struct(*own), KEEP_NULLS)).cast(_FIELDS)
    more = F.coalesce(_without(F.col(extra).cast(_FIELDS), own), F.create_map().cast(_FIELDS))
    records.select(F.to_json(F.to_variant_object(F.map_concat(columns, more))).alias("value")).write.mode(mode).text(path)
    return path
