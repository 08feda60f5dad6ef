import re
from hashlib import sha256

from corpusmill.llm import pii

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)",
    "card": r"[0-9](?:[\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def valid(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in match.split("."))
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits)
    if kind == "phone":
        return 9 <= len(digits) <= 15
    return True


def brute(text):
    return [f"{k}:{m.start()}:{m.end()}" for k, p in PATTERNS.items() for m in re.finditer(p, text or "") if valid(k, m[0])]


CASES = [
    "a.b@c.d_x@e.f g@h i@j.k.", "x@y.z@q.r", "1.2.3.4.5 256.1.1.1 0001.002.3.255 1.2.3", "4465758382889437 4465758382889437",
    "4465 7583-8288 9437, +1 (743) 555-3824.", "+1 2 +12345678901234567890 +123456789", "é 4111111111111111 ü me@mail.example.com",
    "++1234567890", "a%b@c-d.e-f.g_h@i.j", "4111-1111-1111-1111-4111 4111111111111111",
]


def base(row):
    return [s for s in (row["spans"].split(",") if row["spans"] else []) if s.split(":")[0] in PATTERNS]


def test_base_on_documents(run_query, all_texts):
    for key, row in run_query("op2_pii").items():
        want = brute(all_texts[key])
        assert base(row) == want, key
        assert row["base_sha256"] == sha256(",".join(want).encode()).hexdigest()
        assert [row[f"n_{k}"] for k in PATTERNS] == [sum(w.startswith(k + ":") for w in want) for k in PATTERNS]


def test_base_on_cases(spark, awkward):
    docs = spark.createDataFrame(list(enumerate(CASES)), "doc_id long, text string").union(awkward.select("doc_id", "text"))
    texts = [r["text"] for r in docs.collect()]
    rows = pii.pii_digests(docs).collect()
    assert sorted(map(str, (base(r) for r in rows))) == sorted(map(str, map(brute, texts)))
    assert pii.pii_digests(docs.filter("false")).count() == 0


def test_checksums_and_context(spark):
    rows = [
        (0, "account DE89 3704 0044 0532 0130 00 thanks"), (1, "account DE88 3704 0044 0532 0130 00 thanks"),
        (2, "my SSN is 123-45-6789."), (3, "part 123-45-6789."), (4, None),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: r["spans"] for r in pii.pii_digests(docs).collect()}
    assert found == {0: "iban:8:35", 1: "", 2: "national_id:10:21", 3: "", 4: ""}
    assert found[1].find("iban") < 0 and found[3] == "" and found[2] == "national_id:10:21"
    masked = {r["doc_id"]: r["text"] for r in pii.mask_pii(docs).collect()}
    assert masked[2] == "my SSN is [NATIONAL_ID]." and masked[3] == rows[3][1] and masked[4] is None


def test_accounts_before_other_words(spark):
    gb, de, no = "GB29 NWBK 6016 1331 9268 19", "DE89 3704 0044 0532 0130 00", "NO93 8601 1117 947"
    cases = {
        f"{gb} BIC NWBKGB2L": [gb], f"{de} AND": [de], f"{de} 12": [de], f"{de} {gb}": [de, gb], f"{no} {de} {no}": [no, de, no],
        f"ID12 {de} REF 77": [de], f"DE12 3456 {gb}": [gb], f"{de}X": [], f"{de}x": [], f"{de.replace(' ', '')} AB12": [de.replace(" ", "")],
        # A country that is not in the list: the longest one with remainder 1.
        "ZZ97 1234 5678 9012 345 AND": [],
    }
    body = "12345678901234"
    other = f"ZZ{98 - int(body + '353500') % 97:02d}{body}"
    cases |= {f"{other} x": [other], f"{other} é": [other]}
    docs = spark.createDataFrame(list(enumerate(cases)), "doc_id long, text string")
    for row in pii.pii_digests(docs).collect():
        text = list(cases)[row["doc_id"]]
        spans = [s.split(":") for s in row["spans"].split(",") if s.startswith("iban")]
        assert [text[int(a) : int(b)] for _, a, b in spans] == cases[text], text
