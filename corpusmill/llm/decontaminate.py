"""Benchmark decontamination with a generalised suffix automaton of the test items.

All normalised items go into one suffix automaton over words. A document's words are streamed through it; the automaton
keeps the longest suffix of the words read so far that occurs in some item. A match of at least ``window`` words, or of
a whole shorter item, marks the matched words. Nothing is shuffled: documents pass through in place. Items are a stated
query set; they are taken in blocks of at most ``BLOCK_WORDS`` words (an item longer than that is a block of its own),
so what one task holds does not grow with the benchmark. Each further block is one more pass over what the last one wrote:
a stage runs all its steps at once, and steps of one stage would hold the automata of all blocks together.

Defined results: null and empty texts have no words and no hits; items without words never match; items with equal ids
count once; an item with a null id marks words but is not listed; no items at all means no hits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill.llm.arrays import per_process, task
from corpusmill.session import materialize

WINDOW = 13
BLOCK_WORDS = 100_000
COVERAGE = 20  # contaminated when hit words are at least one in this many

_HITS = "__hits"
_ITEMS = "__items"
NEVER = 1 << 60


def word_table() -> bytes:
    """Bytes to lower case, everything that is not a letter, digit or beyond ASCII to a space."""
    keep = [*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]
    table = bytearray(b" " * 256)
    for c in keep:
        table[c] = c
    for c in range(0x41, 0x5B):
        table[c] = c + 32
    return bytes(table)


class SuffixAutomaton:
    """Suffix automaton of many word sequences, with the items that hold each window."""

    def __init__(self, items: list[tuple[str | None, list[bytes]]], window: int):
        self.window = window
        self.words: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.length = [0]
        coded = [(key, [self.words.setdefault(w, len(self.words)) for w in words]) for key, words in items if words]
        for _, ids in coded:
            state = 0
            for word in ids:
                state = self._extend(state, word)
        self._mark(coded)

    def _new(self, length: int, edges: dict[int, int], link: int) -> int:
        self.length.append(length)
        self.next.append(edges)
        self.link.append(link)
        return len(self.length) - 1

    def _split(self, state: int, word: int, target: int) -> int:
        """The state for the strings of ``target`` no longer than ``state`` plus one word."""
        if self.length[target] == self.length[state] + 1:
            return target
        clone = self._new(self.length[state] + 1, dict(self.next[target]), self.link[target])
        self.link[target] = clone
        while state >= 0 and self.next[state].get(word) == target:
            self.next[state][word] = clone
            state = self.link[state]
        return clone

    def _extend(self, state: int, word: int) -> int:
        target = self.next[state].get(word)
        if target is not None:
            return self._split(state, word, target)
        new = self._new(self.length[state] + 1, {}, 0)
        while state >= 0 and word not in self.next[state]:
            self.next[state][word] = new
            state = self.link[state]
        if state >= 0:
            self.link[new] = self._split(state, word, self.next[state][word])
        return new

    def _mark(self, coded: list[tuple[str | None, list[int]]]) -> None:
        """Which items hold a state's window, which short items end in a state, and the length worth reporting."""
        self.holders: dict[int, set] = {}
        self.short: dict[int, tuple[int, set]] = {}
        for key, ids in coded:
            state = 0
            for i, word in enumerate(ids):
                state = self.next[state][word]
                if i + 1 >= self.window:
                    self.holders.setdefault(self._suffix(state, self.window), set()).add(key)
            if len(ids) < self.window:
                self.short.setdefault(state, (len(ids), set()))[1].add(key)
        self.need = [NEVER] * len(self.link)
        for state in sorted(range(1, len(self.link)), key=self.length.__getitem__):
            need = self.need[self.link[state]]
            if state in self.short:
                need = min(need, self.short[state][0])
            if self.length[state] >= self.window:
                need = min(need, self.window)
            self.need[state] = need

    def _suffix(self, state: int, length: int) -> int:
        """The state of the suffix of ``length`` words of a string that ends in ``state``."""
        while self.length[self.link[state]] >= length:
            state = self.link[state]
        return state

    def matches(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set]:
        """Marked word ranges [start, end), merged and in order, and the items found."""
        steps, link, length, need = self.next, self.link, self.length, self.need
        state = size = 0
        ranges: list[list[int]] = []
        found: set = set()
        for i, word in enumerate(map(self.words.get, words)):
            if word is None:
                state = size = 0
                continue
            target = steps[state].get(word)
            while target is None and state:
                state = link[state]
                size = length[state]
                target = steps[state].get(word)
            if target is None:
                size = 0
                continue
            state = target
            size += 1
            if size >= need[state]:
                reach = self._report(state, size, found)
                if ranges and ranges[-1][1] >= i + 1 - reach:
                    ranges[-1][1] = i + 1
                    ranges[-1][0] = min(ranges[-1][0], i + 1 - reach)
                else:
                    ranges.append([i + 1 - reach, i + 1])
        return merge([tuple(r) for r in ranges]), found

    def _report(self, state: int, size: int, found: set) -> int:
        """Add the items of the windows that end here; how many words back the longest of them reaches."""
        reach = 0
        if size >= self.window and self.length[state] >= self.window:
            reach = self.window
            state = self._suffix(state, self.window)
            found |= self.holders[state]
        while state > 0:
            if state in self.short and self.short[state][0] <= size:
                reach = max(reach, self.short[state][0])
                found |= self.short[state][1]
            state = self.link[state]
        return reach


def merge(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(ranges):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def item_blocks(items: DataFrame, id_col: str, text_col: str, block_words: int) -> Iterator[list[tuple]]:
    """Items in blocks of about ``block_words`` words, one block on the driver at a time."""
    sized = items.select(
        F.col(id_col).cast("string").alias("key"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    ).withColumn("n", F.size(F.split("text", "[^0-9A-Za-z\\x{80}-\\x{10FFFF}]+")).cast("long"))
    total, largest = sized.agg(F.sum("n"), F.max("n")).first()
    # Half the limit on average, so that an uneven deal stays below it.
    n_blocks = 1 if (total or 0) <= block_words else -(-2 * total // block_words)
    part = F.pmod(F.xxhash64("key", "text"), F.lit(n_blocks))
    for k in range(n_blocks):
        rows = sized.filter(part == k).select("key", "text").distinct().collect()
        table = word_table()
        block = sorted(((r["key"], r["text"].encode().translate(table).split()) for r in rows), key=lambda x: (x[0] or "", x[1]))
        if any(words for _, words in block):
            yield block


def find_contamination(
    docs: DataFrame, items: DataFrame, text_col: str = "text", item_id: str = "item_id", item_text: str = "text",
    window: int = WINDOW, block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """Every row of ``docs`` with ``n_words``, ``hit_ranges`` (word ranges [start, end)) and ``hit_items`` (sorted ids).

    Columns of ``docs`` that already have one of these names are replaced.
    """
    docs = docs.drop("n_words", "hit_ranges", "hit_items")
    added = [
        T.StructField("n_words", T.LongType()),
        T.StructField("hit_ranges", T.ArrayType(T.ArrayType(T.LongType()))),
        T.StructField("hit_items", T.ArrayType(T.StringType())),
    ]
    schema = T.StructType([*docs.schema.fields, *added])
    out, last, again = _all_but_last(docs, items, text_col, item_id, item_text, window, block_words, schema)
    return out.mapInArrow(_scan(last, text_col, window, again), schema)


def _all_but_last(docs, items, text_col, item_id, item_text, window, block_words, schema):
    """Documents with the results of all blocks of items but the last, that block, and whether there were others."""
    out, last, again = docs, None, False
    for block in item_blocks(items, item_id, item_text, block_words):
        if last is not None:
            out, again = materialize(out.mapInArrow(_scan(last, text_col, window, again), schema), "scanned"), True
        last = block
    return out, last or [], again


def drop_contaminated(
    docs: DataFrame, items: DataFrame, text_col: str = "text", item_id: str = "item_id", item_text: str = "text",
    window: int = WINDOW, block_words: int = BLOCK_WORDS, coverage: int = COVERAGE,
) -> DataFrame:
    """``docs`` without contaminated rows, spans of at least ``window`` words cut out of the others; the columns stay.

    The rules are those of ``is_contaminated`` and ``cut_spans``, applied by the step that scans the last block. No column of ``docs`` may be
    called like the results of ``find_contamination``.
    """
    added = "n_words long, hit_ranges array<array<long>>, hit_items array<string>"
    schema = T.StructType([*docs.schema.fields, *T.StructType.fromDDL(added).fields])
    out, last, again = _all_but_last(docs, items, text_col, item_id, item_text, window, block_words, schema)
    scan, cut = _scan(last, text_col, window, again), _cut(text_col, window)

    def run(batches):
        for batch in scan(batches):
            hits = [sum(end - start for start, end in marked) for marked in batch.column("hit_ranges").to_pylist()]
            clean = [not (hit > 0 and coverage * hit >= n) for hit, n in zip(hits, batch.column("n_words").to_pylist())]
            yield cut(batch.filter(pa.array(clean, pa.bool_()))).drop_columns(["n_words", "hit_ranges", "hit_items"])

    return out.mapInArrow(run, docs.schema)


def _scan(block, text_col: str, window: int, again: bool):
    """Task body for one block; ``again``: rows carry the results of earlier blocks."""
    digest = hashlib.sha256(repr((window, block)).encode()).hexdigest()

    @task("decontaminate")
    def run(batches):
        automaton = per_process("decontaminate", digest, lambda: SuffixAutomaton(block, window))
        table = word_table()
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text_col)).cast(pa.large_binary()).to_pylist()
            counts, ranges, items = [], [], []
            for text in texts:
                words = text.translate(table).split() if text else []
                marked, found = automaton.matches(words)
                counts.append(len(words))
                ranges.append(marked)
                items.append(found)
            if again:
                old_ranges = batch.column("hit_ranges").to_pylist()
                old_items = batch.column("hit_items").to_pylist()
                ranges = [merge([*a, *map(tuple, b)]) for a, b in zip(ranges, old_ranges)]
                items = [a | set(b) for a, b in zip(items, old_items)]
                batch = batch.drop_columns(["n_words", "hit_ranges", "hit_items"])
            ranges = [[list(r) for r in x] for x in ranges]
            items = [sorted(x - {None}) for x in items]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(counts, pa.int64()), pa.array(ranges, pa.list_(pa.list_(pa.int64()))), pa.array(items, pa.list_(pa.string()))],
                [*batch.schema.names, "n_words", "hit_ranges", "hit_items"],
            )

    return run


def n_hit(ranges: str = "hit_ranges"):
    """Number of marked words."""
    return F.aggregate(F.col(ranges), F.lit(0).cast("long"), lambda acc, r: acc + r[1] - r[0])


def is_contaminated(hit, words, coverage: int = COVERAGE):
    return (hit > 0) & (coverage * hit >= words)


def cut_spans(docs: DataFrame, text_col: str = "text", min_span: int = WINDOW) -> DataFrame:
    """Cut marked spans of at least ``min_span`` words out of the texts of ``find_contamination``.

    The words of a span go with everything between them; the text around a cut is joined by one space. Rows without
    such spans keep their text byte for byte.
    """

    cut = _cut(text_col, min_span)

    @task()
    def run(batches):
        for batch in batches:
            yield cut(batch)

    return docs.mapInArrow(run, docs.schema)


def _cut(text_col: str, min_span: int):
    """Batch with its marked spans of ``min_span`` words or more cut out of the texts."""

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        import re

        word, table = re.compile(rb"[^ ]+"), word_table()
        texts = batch.column(batch.schema.get_field_index(text_col)).to_pylist()
        ranges = batch.column("hit_ranges").to_pylist()
        for i, (text, marked) in enumerate(zip(texts, ranges)):
            marked = [r for r in marked or () if r[1] - r[0] >= min_span]
            if not marked:
                continue
            raw = text.encode()
            at = [m.span() for m in word.finditer(raw.translate(table))]
            parts, last = [], 0
            for start, end in marked:
                parts.append(raw[last : at[start][0]].rstrip())
                last = at[end - 1][1]
            parts.append(raw[last:].lstrip())
            texts[i] = b" ".join(p for p in parts if p).decode()
        index = batch.schema.get_field_index(text_col)
        return batch.set_column(index, text_col, pa.array(texts, batch.schema.field(index).type))

    return cut
