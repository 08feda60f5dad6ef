"""Unknown record fields survive a read and a write."""

import json

from corpusmill.sources.open_records import read_open_records, write_open_records


def test_round_trip_of_unknown_fields(spark, tmp_path):
    lines = [
        {"id": "a", "title": "one", "odd": {"x": [1, 2.5, None, "é"]}, "flag": True},
        {"id": "b", "questions": ["plain"], "keywords": ["k"]},
        {"id": "c", "score": 12345678901234, "none": None, "list": []},
    ]
    source = tmp_path / "in.jsonl"
    source.write_text("\n".join(map(json.dumps, lines)) + "\n\n[1, 2]\nnot json\n", encoding="utf-8")
    rows = read_open_records(spark, str(source))
    got = {r["id"]: r for r in rows.collect()}
    assert json.loads(got["a"]["extra"].toJson()) == {"odd": {"x": [1, 2.5, None, "é"]}, "flag": True}
    assert got["b"]["extra"] is None and got["b"]["questions"][0]["text"] == "plain"
    assert json.loads(got["c"]["extra"].toJson()) == {"score": 12345678901234, "none": None, "list": []}
    assert rows.filter("id is null").count() == 2 and rows.filter("id is null and extra is null").count() == 2

    written = spark.read.text(write_open_records(rows.filter("id is not null"), str(tmp_path / "out")))
    back = {r["id"]: r for r in (json.loads(x["value"]) for x in written.collect())}
    for line in lines:
        for name, value in line.items():
            if name != "questions":
                assert back[line["id"]][name] == value
    assert back["a"]["content"] is None and "extra" not in back["a"]
    again = read_open_records(spark, str(tmp_path / "out"))
    assert {r["id"]: r["extra"] and json.loads(r["extra"].toJson()) for r in again.collect()} == {
        k: r["extra"] and json.loads(r["extra"].toJson()) for k, r in got.items() if k
    }
