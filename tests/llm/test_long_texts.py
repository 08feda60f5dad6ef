"""Time and output that follow the length of a text, and memory that does not pile up in worker processes."""

import sys
import time

import pytest

from corpusmill.llm import arrays, html_layout, pii, secret_scan


def seconds(run):
    start = time.perf_counter()
    out = run()
    return time.perf_counter() - start, out


def test_one_operator_at_a_time_keeps_values():
    arrays.per_process("a", "x", lambda: 1)
    arrays.per_process("a", "y", lambda: 2)
    assert arrays.per_process("a", "x", lambda: 3) == 1
    assert arrays.per_process("b", "x", lambda: 4) == 4
    assert set(sys._corpusmill_values) == {"b"} and arrays.per_process("a", "x", lambda: 5) == 5
    arrays.release()
    assert not sys._corpusmill_values


def test_many_addresses(spark):
    text = " ".join(f"user{i}@mail{i}.example.org" for i in range(20_000))
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    took, rows = seconds(lambda: pii.pii_digests(docs).collect())
    assert rows[0]["n_email"] == 20_000 and took < 25  # 51 s where every span was appended to the whole array


def test_many_assignments():
    text = " ".join(f'password = "Abcdef{i:06d}xyz" token$%{i}Q9z8y7x6w5v4u3t2s1' for i in range(10_000))
    scan = secret_scan.SecretScanner(secret_scan.NOVELTY, secret_scan.MIN_TOKEN).scan
    took, spans = seconds(lambda: scan(text))
    assert sum(s.kind == "assign" for s in spans) == 10_000 and took < 20


@pytest.mark.parametrize("piece", ["<a ", "<!-- ", "<a href=\"", "</", "<"])
def test_unfinished_tags(piece):
    page = "seen " + piece * (300_000 // len(piece))
    took, text = seconds(lambda: html_layout.Renderer().page(page))
    assert text.startswith("seen") and took < 5
    took, text = seconds(lambda: html_layout.Renderer().page(page + ">"))
    assert took < 5


def test_deep_lists_do_not_multiply_output():
    page = "".join(f"<ul><li>item {i}" for i in range(4_000))
    took, text = seconds(lambda: html_layout.Renderer().page(page))
    assert len(text) < 4 * len(page) and all(f"item {i}" in text for i in (0, 1_999, 3_999)) and took < 20


def test_unfinished_comment_hides_the_rest():
    assert html_layout.Renderer().page("a <!-- b <i>c</i> d") == "a"
    assert html_layout.Renderer().page("a <b>b</b> <!-- c") == "a b"
