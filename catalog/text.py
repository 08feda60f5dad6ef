"""Text, date, map and relation functions as column jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import (
    RECORDS_SQL,
    STOP_WORDS,
    clean_sql,
    documents,
    fold_sql,
    query,
    record_text_sql,
    records_base,
    stop_sql,
    table,
    topic_sql,
    translate_sql,
)
from corpusmill.functions import dates, questions, relations
from corpusmill.functions import text as X
from corpusmill.functions.common import all_finite, explode_positions
from corpusmill.functions.topics import classify_topic
from corpusmill.operators.entities import find_entities
from corpusmill.session import spread


@query(
    "clean_text",
    rf"""SELECT doc_id, {clean_sql("text || ' World Page end'")} AS clean, length({clean_sql("text")}) AS n
    FROM documents""",
)
def clean_text(spark, sf):
    wrapped = F.concat(
        F.lit("<p>"), F.col("text"), F.lit("<sup>1</sup> [[Link|World]]\n[[Page]] [23]<!-- x --></p><br/>end")
    )
    return documents(spark, sf).select(
        "doc_id", X.clean_text(wrapped).alias("clean"), F.length(X.clean_text(F.col("text"))).alias("n")
    )


@query("clean_wiki_text", rf"""SELECT doc_id, {clean_sql("text || ' World ' || lang")} AS clean FROM documents""")
def clean_wiki_text(spark, sf):
    wrapped = F.concat(
        F.lit("<div class='x'>"), F.col("text"), F.lit("</div> [[Link|World]] {{temp\n|a=1}} [["), F.col("lang"), F.lit("]]")
    )
    return documents(spark, sf).select("doc_id", X.clean_wiki_text(wrapped).alias("clean"))


@query(
    "advanced_clean_text",
    f"""SELECT doc_id, {record_text_sql("text", "lang")} AS clean FROM documents""",
)
def advanced_clean_text(spark, sf):
    wrapped = F.concat(
        F.lit("{{Infobox}} <p>"), F.col("text"),
        F.lit('</p> {| class="wikitable" | data |} [7]\n== Referências ==\nrest\n== External links ==\nmore'),
    )
    return documents(spark, sf).select("doc_id", X.advanced_clean_text(wrapped, F.col("lang")).alias("clean"))


@query(
    "see_also_tail",
    f"""SELECT doc_id, {record_text_sql("text", "lang")} AS clean FROM documents""",
)
def see_also_tail(spark, sf):
    tail = F.when(F.col("lang") == "fr", " Voir aussi: x. y").when(F.col("lang") == "es", " VÉASE TAMBIÉN x").otherwise(
        " see also x"
    )
    return documents(spark, sf).select(
        "doc_id", X.advanced_clean_text(F.concat("text", tail), F.col("lang")).alias("clean")
    )


@query("fold_accents", f"SELECT doc_id, {fold_sql('text')} AS folded FROM documents")
def fold_accents(spark, sf):
    return documents(spark, sf).select("doc_id", X.fold_accents(F.col("text")).alias("folded"))


@query(
    "remove_stop_words",
    rf"""SELECT doc_id, list_aggregate(list_filter(string_split_regex(text, '\s+'),
      lambda w: w <> '' AND NOT {stop_sql("lang", "lower(w)")}), 'string_agg', ' ') AS kept FROM documents""",
)
def remove_stop_words(spark, sf):
    kept = X.remove_stop_words(F.col("text"), F.col("lang"), STOP_WORDS)
    return documents(spark, sf).select("doc_id", kept.alias("kept"))


_SENTENCES = r"""list_filter(list_transform(string_split_regex(text, '[.!?]+'),
  lambda s: regexp_replace(s, '^\s+|\s+$', '', 'g')), lambda s: s <> '')"""


@query(
    "split_sentences",
    f"""SELECT doc_id, unnest(s) AS sentence, generate_subscripts(s, 1) - 1 AS pos
    FROM (SELECT doc_id, {_SENTENCES} AS s FROM documents)""",
)
def split_sentences(spark, sf):
    return explode_positions(documents(spark, sf), X.split_sentences(F.col("text")), "doc_id", value="sentence")


@query(
    "parse_date",
    """SELECT o_orderkey, form, strftime(o_orderdate, '%Y-%m-%d') AS parsed
    FROM orders, (SELECT unnest([0, 1, 2, 3, 4, 5]) AS form)
    UNION ALL SELECT o_orderkey, 6 AS form, '' AS parsed FROM orders""",
)
def parse_date(spark, sf):
    d = F.col("o_orderdate")
    forms = F.array(
        F.date_format(d, "MMMM d, yyyy"),
        F.concat(F.lit("on "), F.date_format(d, "d MMM yyyy"), F.lit(" in town")),
        F.date_format(d, "yyyy-MM-dd HH:mm"),
        F.date_format(d, "MM/dd/yyyy"),
        F.concat(F.lit("issued "), F.date_format(d, "yyyyMMdd")),
        F.concat(F.date_format(d, "MMM"), F.lit(". "), F.date_format(d, "d"), F.lit("th, "), F.date_format(d, "yyyy")),
        F.concat(F.lit("order "), F.col("o_orderkey").cast("string"), F.lit(" of "), F.date_format(d, "MMMM")),
    )
    orders = spread(table(spark, sf, "orders"), "o_orderkey")
    rows = orders.select("o_orderkey", F.posexplode(forms).alias("form", "written"))
    return rows.select("o_orderkey", "form", dates.parse_date(F.col("written")).alias("parsed"))


@query(
    "normalize_infobox",
    """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS order_date, o_orderpriority AS priority,
       '' AS last_update FROM orders""",
)
def normalize_infobox(spark, sf):
    box = F.create_map(
        F.lit("Order Date"), F.concat(F.lit(" "), F.date_format("o_orderdate", "d MMMM yyyy"), F.lit("\n")),
        F.lit("priority"), F.concat(F.lit("  "), F.col("o_orderpriority"), F.lit(" ")),
        F.lit("update"), F.lit("unknown"),
    )
    boxes = table(spark, sf, "orders").select("o_orderkey", dates.normalize_infobox(box).alias("b"))
    return boxes.select(
        "o_orderkey",
        F.col("b")["Order Date"].alias("order_date"),
        F.col("b")["priority"].alias("priority"),
        F.col("b")["update"].alias("last_update"),
    )


@query(
    "normalize_person",
    """SELECT c_custkey, c_name AS name, '' AS birth_date,
       CASE WHEN c_acctbal > 0 THEN 2 ELSE 1 END AS n_occupations,
       CASE WHEN c_acctbal > 0 THEN c_mktsegment ELSE '' END AS first_occupation FROM customer""",
)
def normalize_person(spark, sf):
    box = F.map_filter(
        F.create_map(
            F.lit("name"), F.col("c_name"),
            F.lit("occupation"), F.when(F.col("c_acctbal") > 0, F.concat("c_mktsegment", F.lit("|owner"))),
        ),
        lambda k, v: v.isNotNull(),
    )
    people = table(spark, sf, "customer").select("c_custkey", dates.normalize_person(box).alias("p"))
    return people.select(
        "c_custkey", "p.name", "p.birth_date",
        F.size("p.occupation").alias("n_occupations"), F.get("p.occupation", F.lit(0)).alias("first_occupation"),
    )


@query(
    "extract_relations",
    """SELECT p_partkey, 'Brand' AS subject, 'worked at' AS relation, 'Type' AS object, 0 AS pos FROM part
    UNION ALL SELECT p_partkey, 'X' || substr(p_type, 1, 1), 'discovered', upper(substr(p_name, 1, 1)) || 'a', 1 FROM part""",
)
def extract_relations(spark, sf):
    text = F.concat(
        F.lit("The Brand worked at Type, then X"), F.substring("p_type", 1, 1), F.lit(" discovered "),
        F.upper(F.substring("p_name", 1, 1)), F.lit("a. none worked at home; Ann studied at 9x"),
    )
    found = table(spark, sf, "part").select(
        "p_partkey", F.posexplode(relations.extract_relations(text)).alias("pos", "r")
    )
    return found.select("p_partkey", "r.subject", "r.relation", "r.object", "pos")


@query(
    "find_entities",
    """SELECT s_suppkey, 3 AS pos, n_name AS text, 'LOC' AS type FROM supplier JOIN nation ON s_nationkey = n_nationkey
    UNION ALL SELECT s_suppkey, 5, r_name, 'REGION' FROM supplier JOIN nation ON s_nationkey = n_nationkey
      JOIN region ON n_regionkey = r_regionkey""",
)
def find_entities_query(spark, sf):
    nation, region = table(spark, sf, "nation"), table(spark, sf, "region")
    gazetteer = nation.select(F.col("n_name").alias("name"), F.lit("LOC").alias("type")).unionByName(
        region.select(F.col("r_name").alias("name"), F.lit("REGION").alias("type"))
    )
    homes = (
        table(spark, sf, "supplier")
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    )
    docs = homes.select(
        F.col("s_suppkey").alias("seq"),
        F.concat(F.lit("A seller from "), "n_name", F.lit(", in "), "r_name", F.lit(".")).alias("content"),
    )
    return find_entities(docs, gazetteer).withColumnRenamed("seq", "s_suppkey")


_TOPIC, _SUBTOPIC = topic_sql("lower(title || chr(10) || content)")


@query(
    "classify_topic",
    f"WITH {RECORDS_SQL} SELECT seq, {_TOPIC} AS topic, {_SUBTOPIC} AS subtopic FROM records_base",
)
def topics(spark, sf):
    found = records_base(spark, sf).select("seq", classify_topic(F.col("title"), F.col("content")).alias("t"))
    return found.select("seq", "t.topic", "t.subtopic")


_QUESTION = "'How does ' || title || ' relate to What is the role of ' || category || ' in the context of x?'"


@query(
    "translate_question",
    f"WITH {RECORDS_SQL}, q AS (SELECT *, {_QUESTION} AS question FROM records_base) "
    f"SELECT seq, {translate_sql('question', 'language')} AS translated FROM q",
)
def translate_question(spark, sf):
    question = F.concat(
        F.lit("How does "), "title", F.lit(" relate to What is the role of "), "category", F.lit(" in the context of x?")
    )
    return records_base(spark, sf).select(
        "seq", questions.translate_question(question, F.col("language")).alias("translated")
    )


@query("record_id", f"WITH {RECORDS_SQL} SELECT seq, id FROM records_base")
def record_id(spark, sf):
    return documents(spark, sf).select(
        F.col("doc_id").alias("seq"), F.md5(F.concat(F.lit("doc "), "doc_id", F.lit("_"), "lang")).alias("id")
    )


@query("html_body_to_text", f"SELECT doc_id, {clean_sql('text')} AS body FROM documents")
def html_body(spark, sf):
    wrapped = F.concat(F.lit("<div><b>"), F.col("text"), F.lit("</b><script>var x = '<i>';</script></div>"))
    return documents(spark, sf).select("doc_id", X.clean_text(wrapped).alias("body"))


@query(
    "finite_vectors",
    """SELECT vec_id, label <> 3 AS finite FROM embeddings""",
)
def finite_vectors(spark, sf):
    vector = F.transform(
        "embedding", lambda x, i: F.when((F.col("label") == 3) & (i == 5), F.lit(float("nan"))).otherwise(x)
    )
    return table(spark, sf, "embeddings").select("vec_id", all_finite(vector).alias("finite"))
