r"""Personal data by patterns, checksums and context.

Regular expressions propose spans. Checksums confirm those that have one: Luhn for cards, mod 97 for bank accounts.
A bank account number has the length of its country, or, where the country is not in the list, the longest one with
remainder 1; every place where one can begin is tried, so what stands before or behind it does not matter. Words within ``CONTEXT`` characters before a span adjust its score. The four base kinds always stay; further kinds
(``iban``, and ``national_id`` for grouped nine-digit numbers) are reported from score ``REPORT`` on.

Native column functions only, row by row, nothing is shuffled. Spark has no function for match positions, so they are
summed up from the pieces between matches: splitting by the same pattern gives the gaps. Patterns are written with
possessive parts and left borders, so that long runs of one kind of character take linear time.

Defined results: null and empty texts have no spans; offsets are code points, ends exclusive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.functions.common import let

BASE_KINDS = ["email", "ip", "card", "phone"]
EXTRA_KINDS = ["iban", "national_id"]
KINDS = BASE_KINDS + EXTRA_KINDS
CONTEXT = 60
RUN = 128  # matches whose positions are added up together
REPORT = 0.6

# The contract's patterns. \G lets a match begin where the last one ended.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    # The first four characters; the group holds all that can follow, and one more character that shows the border.
    "iban": r"(?<![A-Za-z0-9])(?=([A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}+[A-Za-z0-9]?))[A-Z]{2}[0-9]{2}",
    "national_id": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
}
# Lengths of bank account numbers by country, from the registry of ISO 13616.
IBAN_LENGTHS = {
    code: size for size, codes in {
        15: "NO", 16: "BE", 18: "DK FK FI FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
        22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
        25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV",
        29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
    }.items() for code in codes.split()
}
# What a text needs for the pattern to be worth running.
GUARDS = {
    "email": r"@[A-Za-z0-9-]", "ip": r"[0-9]\.[0-9]", "card": r"(?:[0-9][\x20-]?){12}[0-9]", "phone": r"\+[0-9]",
    "iban": r"[A-Z]{2}[0-9]{2}", "national_id": r"[0-9]{3}-[0-9]{2}-[0-9]{4}",
}
# Score of a confirmed span without context, and what a context word adds.
SCORES = {"email": 0.9, "ip": 0.7, "card": 0.8, "phone": 0.7, "iban": 0.9, "national_id": 0.4}
CONTEXT_GAIN = 0.3
CONTEXT_WORDS = {
    "email": "mail|contact|write|kontakt|correo",
    "ip": r"\bip\b|address|host|server|adresse",
    "card": "card|visa|mastercard|credit|karte|carte|tarjeta",
    "phone": r"phone|\btel\b|call|mobile|fax|telefon",
    "iban": "iban|account|bank|konto|compte|cuenta",
    "national_id": "ssn|social security|national id|passport|identity|ausweis",
}


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _mod97(text: Column) -> Column:
    """Remainder of a bank account number: the first four characters last, letters as numbers from 10."""
    flat = F.replace(text, F.lit(" "))
    turned = F.concat(F.substring(flat, 5, 40), F.substring(flat, 1, 4))
    step = lambda acc, c: F.when(
        c.between("0", "9"), (acc * 10 + F.ascii(c) - 48) % 97
    ).otherwise((acc * 100 + F.ascii(c) - 55) % 97)
    return F.aggregate(F.split(turned, ""), F.lit(0), step)


def _account(run: Column) -> Column:
    """The bank account number at the beginning of ``run``, else null."""
    lengths = F.create_map(*[F.lit(x) for pair in IBAN_LENGTHS.items() for x in pair])
    wanted = F.try_element_at(lengths, F.substring(run, 1, 2))

    def fits(i: Column) -> Column:
        part = F.substr(run, F.lit(1), i)
        size = F.length(F.replace(part, F.lit(" ")))
        ends = part.rlike("[A-Z0-9]$") & ~F.substr(run, i + 1, F.lit(1)).rlike("[A-Za-z0-9]")
        return ends & size.between(15, 34) & (size == F.coalesce(wanted, size)) & (_mod97(part) == 1)

    ends = F.filter(F.sequence(F.length(run), F.lit(15), F.lit(-1)), fits)
    return F.substr(run, F.lit(1), F.get(ends, F.lit(0)))


def confirmed(kind: str, text: Column) -> Column:
    """Whether a match is valid for its kind."""
    if kind == "ip":
        return ~F.exists(F.split(text, r"\."), lambda p: ~p.rlike("^0*([0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"))
    if kind == "card":
        return F.length(_digits(text)).between(13, 19) & F.call_function("luhn_check", _digits(text))
    if kind == "phone":
        return F.length(_digits(text)).between(9, 15)
    return F.lit(True)


def spans_of(kind: str, text: Column) -> Column:
    """Confirmed spans of one kind with scores, by start."""
    pattern = F.lit(PATTERNS[kind])
    matches = F.regexp_extract_all(text, pattern, F.lit(0))
    # The text of a span is the match, of an account the part of what follows its head that is one.
    runs = F.regexp_extract_all(text, pattern, F.lit(1)) if kind == "iban" else F.lit(None).cast("array<string>")
    cut = F.struct(F.split(text, PATTERNS[kind], -1).alias("gaps"), matches.alias("matches"), runs.alias("runs"))
    none_yet = F.array().cast("array<struct<start:int,match:string,i:int>>")

    def add(acc: Column, p: Column) -> Column:
        begin = acc["at"] + p["gap"]
        valid = p["match"].isNotNull() & (begin >= acc["free"]) & confirmed(kind, p["match"])
        one = F.struct(begin.alias("start"), p["match"].alias("match"), p["i"].alias("i"))
        return F.struct(
            (begin + F.coalesce(p["size"], F.lit(0))).alias("at"),
            F.when(valid, begin + F.length(p["match"])).otherwise(acc["free"]).alias("free"),
            F.when(valid, F.concat(acc["found"], F.array(one))).otherwise(acc["found"]).alias("found"),
        )

    def spans(c: Column) -> Column:
        texts = F.transform(c["runs"], _account) if kind == "iban" else c["matches"]
        sizes = F.transform(F.arrays_zip(c["gaps"].alias("g"), c["matches"].alias("m"), texts.alias("r")), lambda p, i: F.struct(
            F.length(p["g"]).alias("gap"), F.length(p["m"]).alias("size"), p["r"].alias("match"), i.alias("i")
        ))
        # Positions in runs of RUN matches, so that appending to an array copies no more than a run.
        last = F.floor((F.size(c["gaps"]) - 1) / RUN).cast("int")
        runs = let(sizes, lambda x: F.transform(F.sequence(F.lit(0), last), lambda k: F.slice(x, k * RUN + 1, F.lit(RUN))))
        begin = F.struct(F.lit(0).alias("at"), F.lit(0).alias("free"), F.array().cast("array<array<struct<start:int,match:string,i:int>>>").alias("found"))

        def add_run(acc: Column, run: Column) -> Column:
            done = F.aggregate(run, F.struct(acc["at"].alias("at"), acc["free"].alias("free"), none_yet.alias("found")), add)
            return let(done, lambda d: F.struct(d["at"].alias("at"), d["free"].alias("free"), F.concat(acc["found"], F.array(d["found"])).alias("found")))

        found = F.aggregate(runs, begin, add_run, lambda acc: F.flatten(acc["found"]))
        joined = F.zip_with(c["gaps"], c["matches"], lambda g, m: F.concat(g, F.coalesce(m, F.lit(""))))
        both = F.struct(found.alias("found"), joined.alias("joined"), c["gaps"].alias("gaps"))
        return let(both, lambda b: F.transform(b["found"], lambda p: scored(b, p)))

    def scored(b: Column, p: Column) -> Column:
        # The characters before a span stand in its own gap and, as matches have two or more, in a bounded number of pieces before it.
        n = F.least(p["i"], F.lit(CONTEXT // 2))
        earlier = F.array_join(F.slice(b["joined"], p["i"] - n + 1, n), "")
        before = F.right(F.concat(earlier, F.element_at(b["gaps"], p["i"] + 1)), F.lit(CONTEXT))
        gain = F.when(before.rlike(f"(?i){CONTEXT_WORDS[kind]}"), CONTEXT_GAIN).otherwise(0.0)
        return F.struct(
            F.lit(kind).alias("kind"), p["start"].cast("long").alias("start"),
            (p["start"] + F.length(p["match"])).cast("long").alias("end"),
            F.least(F.lit(1.0), F.round(F.lit(SCORES[kind]) + gain, 2)).alias("score"),
        )

    out = let(cut, spans)
    if kind in EXTRA_KINDS:
        out = F.filter(out, lambda s: s["score"] >= REPORT)
    none = F.array().cast("array<struct<kind:string,start:bigint,end:bigint,score:double>>")
    return F.when(text.rlike(GUARDS[kind]), out).otherwise(none)


def find_pii(docs: DataFrame, text_col: str = "text", spans_col: str = "spans") -> DataFrame:
    """Every row of ``docs`` with its spans by kind and start; a column of that name is replaced."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.withColumn(spans_col, F.concat(*[spans_of(kind, text) for kind in KINDS]))


def listed(spans: Column) -> Column:
    """Spans as ``kind:start:end``, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def pii_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts of the base kinds, digest of the base spans and all spans as text."""
    found = find_pii(docs.select(id_col, text_col), text_col, "__spans").select(id_col, "__spans")
    of = lambda *kinds: F.filter("__spans", lambda s: s["kind"].isin(*kinds))
    return found.select(
        id_col,
        *[F.size(of(k)).cast("long").alias(f"n_{k}") for k in BASE_KINDS],
        F.sha2(listed(of(*BASE_KINDS)).cast("binary"), 256).alias("base_sha256"),
        listed(F.col("__spans")).alias("spans"),
        F.coalesce(F.array_max(F.transform("__spans", lambda s: s["score"])), F.lit(0.0)).alias("top_score"),
    )


def mask_pii(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with each span replaced by ``[KIND]``, overlapping spans by the first one's kind; null texts stay null."""
    found = find_pii(docs, text_col, "__spans")
    ordered = F.sort_array(F.transform("__spans", lambda s: F.struct(s["start"], s["end"], s["kind"])))
    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        piece = F.substring(F.col(text_col), (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int"))
        new = F.concat(acc["out"], piece, F.lit("["), F.upper(s["kind"]), F.lit("]"))
        return F.when(s["start"] >= acc["at"], F.struct(s["end"].alias("at"), new.alias("out"))).otherwise(
            F.struct(F.greatest(acc["at"], s["end"]).alias("at"), acc["out"].alias("out"))
        )

    rest = lambda acc: F.concat(acc["out"], F.substring(F.col(text_col), (acc["at"] + 1).cast("int"), F.length(text_col)))
    masked = F.when(F.size("__spans") > 0, F.aggregate(ordered, start, step, rest)).otherwise(F.col(text_col))
    return found.withColumn(text_col, masked).drop("__spans")
