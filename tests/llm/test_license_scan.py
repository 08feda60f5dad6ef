from corpusmill.llm import license_scan as ls


def test_families_and_unknown(spark, documents):
    model = ls.train(documents)
    cases = [
        ("Released under the MIT License.", "mit"), ("Licensed under the Apache License, Version 2.0.", "apache-2.0"),
        ("This work is licensed under the GNU General Public License, version 3.", "gpl-3.0"), ("Licensed under CC BY-NC 4.0.", "cc-by-nc"),
        ("the text is licensed under CC BY-SA 4.0.", "cc-by-sa"), ("SPDX-License-Identifier: MPL-2.0", "mpl-2.0"),
        ("Licensed under the treaty of the two towns.", "unknown"), ("Her driving license is out of date.", "unknown"), ("Copyright is a right.", "unknown"),
    ]
    rows = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(cases)], "id long, sentence string")
    got = {r["sentence"]: r["family"] for r in model.classify(rows, "sentence").collect()}
    assert got == dict(cases)


def test_documents(run_query, all_texts):
    got = run_query("op6_licenses")
    assert len(got) == len(all_texts)
    # License lines of the tables.
    known = {"Released under the MIT License.": "mit", "Licensed under the Apache License, Version 2.0.": "apache-2.0", "GNU General Public License, version 3": "gpl-3.0", "CC BY-NC 4.0": "cc-by-nc"}
    for key, text in all_texts.items():
        assert got[key]["families"] == ",".join(sorted({f for t, f in known.items() if t in (text or "")})), key


def test_awkward(awkward):
    rows = ls.document_licenses(awkward).collect()
    assert len(rows) == awkward.count() and all(r["n_licensed"] == 0 and r["families"] == "" for r in rows)
    assert ls.document_licenses(awkward.filter("false")).count() == 0


def test_footers_at_the_head_are_no_ordinary_sentences(spark):
    footer = "Released under the MIT License."
    rows = [(i, "\n".join([f"Plain sentence number {i} of the head.", footer, footer])) for i in range(1_200)]
    rows += [(i, f"The river {i} runs past the town.\nA quiet garden {i} lies behind it.") for i in range(1_200, 3_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    sample = [r["text"] for r in ls._ordinary(docs, "text").collect()]
    assert len(sample) == len(set(sample)) == ls.SAMPLE_SENTENCES and footer not in sample
    assert any("garden" in s for s in sample) and any("head" in s for s in sample)
    got = {r["doc_id"]: r["families"] for r in ls.document_licenses(docs).collect()}
    assert got == {i: "mit" if i < 1_200 else "" for i in range(3_000)}
