"""Quality classifier from weak labels.

Overlapping heuristic labellers vote good, bad or nothing on each document, one set for quality and one for toxicity. A
human label, where a table of labels is given, is one more vote. Votes are counted per pattern over all documents (at
most 3^labellers rows whatever the input), and expectation-maximisation on those counts estimates the share of the bad
class and each labeller's accuracy. The posteriors become soft labels of a bounded sample, on which a hashed linear
scorer is trained; the scorer, not the labellers, decides about every document.

The sample is the only bounded part: about ``SAMPLE_ROWS`` documents by hash of id, from the labelled ones if there are
labels. Votes, counts and scores cover all
documents and whole texts. Documents pass through in place; only (id, pattern) rows are shuffled.

Defined results: null and empty texts have no votes and no words; they score by the intercept and their size feature,
and are not ``kept``. Equal texts score equally. An empty table trains on nothing and keeps nothing.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill.llm.arrays import NOT_NEWLINE, NOT_SPACE, byte_set, chunks, hash_spans, mix, shingles, spans, task
from corpusmill.session import materialize

BITS = 20
FIGURES = 128  # the first buckets, for steps of figures; words share the others
PREFIXES = (4, 5, 6)  # bytes of a word's beginning that become features, besides the whole of shorter words
SAMPLE_ROWS = 20_000
EPOCHS = 25
RATE = 0.2
BATCH = 64
DECAY = 1e-5
LEAST_DOCUMENTS = 3
LEAN = 5.0
MOST_FEATURES = 2_000
THRESHOLD = 0.3
_BUCKET = 1 << 20

# Insults that make a document suspect; the scorer learns further words from the labels.
INSULTS = "idiot moron stupid worthless pathetic clown loser dumb imbecile trash".split()

QUALITY_LABELLERS = ["symbols", "capitals", "repeats", "bars", "lines", "length", "shape", "plain"]
TOXIC_LABELLERS = ["insult", "insults"]

# Votes: 0 none, 1 good, 2 bad.
NONE, GOOD, BAD = 0, 1, 2

_SYMBOL = byte_set((0x23, 0x26), (0x2A, 0x2A), (0x3C, 0x3C), (0x3E, 0x3E), (0x7C, 0x7C), (0x21, 0x21))
_UPPER = byte_set((0x41, 0x5A))
_LOWER = byte_set((0x61, 0x7A))
_BAR = byte_set((0x7C, 0x7C))
_WORD = byte_set((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))


def text_features(raw: np.ndarray, at: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray, np.ndarray]:
    """Shape figures of each text, and the hashes of its words' beginnings: (figures, text index, hash)."""
    n = len(at) - 1
    starts, ends, row = spans(raw, at, _WORD)
    words = hash_spans(raw, starts, ends)
    cells, cell_ends, cell_row = spans(raw, at, NOT_SPACE)
    lines, line_ends, line_row = spans(raw, at, NOT_NEWLINE)
    # Only lines with a word count.
    held = np.searchsorted(cells, line_ends) > np.searchsorted(cells, lines)
    line_hash = hash_spans(raw, lines[held], line_ends[held], fold=False)
    line_row = line_row[held]

    def per_text(mask):
        total = np.concatenate(([0], np.cumsum(mask[raw], dtype=np.int64)))
        return (total[at[1:]] - total[at[:-1]]).astype(float)

    def distinct(hashes, rows):
        order = np.lexsort((hashes, rows))
        h, r = hashes[order], rows[order]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (r[1:] != r[:-1])
        return np.bincount(r[new], minlength=n).astype(float)

    n_cells = np.bincount(cell_row, minlength=n).astype(float)
    n_words = np.bincount(row, minlength=n).astype(float)
    n_lines = np.bincount(line_row, minlength=n).astype(float)
    size = np.maximum(np.diff(at).astype(float), 1)
    triples, owner = shingles(words, row, n, 3)
    rows, codes = [], []
    for size_of in PREFIXES:
        long = ends - starts >= size_of
        rows.append(row[long])
        codes.append(hash_spans(raw, starts[long], starts[long] + size_of) + np.uint64(size_of))
    short = ends - starts < PREFIXES[0]
    rows.append(row[short])
    codes.append(words[short])
    insult = np.isin(words, hash_words(INSULTS))
    figures = {
        "cells": n_cells,
        "symbols": per_text(_SYMBOL) / size,
        "capitals": per_text(_UPPER) / np.maximum(per_text(_UPPER) + per_text(_LOWER), 1),
        "repeats": 1 - np.bincount(owner, minlength=n) / np.maximum(n_words - 2, 1),
        "bars": per_text(_BAR) / np.maximum(n_cells, 1),
        "lines": 1 - np.where(n_lines > 0, distinct(line_hash, line_row) / np.maximum(n_lines, 1), 1),
        "shape": size / np.maximum(n_cells, 1),
        "insults": np.bincount(row[insult], minlength=n).astype(float),
    }
    figures["repeats"] = np.clip(figures["repeats"], 0, 1)
    return figures, np.concatenate(rows), np.concatenate(codes)


def hash_words(words: list[str]) -> np.ndarray:
    raw = np.frombuffer(" ".join(words).encode(), np.uint8)
    starts, ends, _ = spans(raw, np.array([0, len(raw)]), NOT_SPACE)
    return hash_spans(raw, starts, ends)


def votes(figures: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """One column of votes per labeller, for quality and for toxicity.

    A document can be bad in one way only, so labellers name what they see and otherwise stay silent; ``plain`` is the
    one that speaks for a document.
    """
    f, some = figures, figures["cells"] > 0

    def bad(seen):
        return np.where(some & seen, BAD, NONE)

    quality = [
        bad(f["symbols"] > 0.05),
        bad(f["capitals"] > 0.3),
        bad(f["repeats"] > 0.3),
        bad(f["bars"] > 0.2),
        bad(f["lines"] > 0.4),
        bad(f["cells"] < 10),
        bad((f["shape"] < 3) | (f["shape"] > 12)),
        np.where((f["symbols"] < 0.02) & (f["capitals"] < 0.12) & (f["repeats"] < 0.1) & (f["bars"] < 0.02) & (f["cells"] >= 25), GOOD, NONE),
    ]
    toxic = [bad(f["insults"] >= 1), bad(f["insults"] >= 2)]
    return np.stack(quality, 1), np.stack(toxic, 1)


def pattern(columns: np.ndarray) -> np.ndarray:
    """Votes as one number in base three."""
    return (columns * 3 ** np.arange(columns.shape[1])).sum(1)


def unpack(numbers: np.ndarray, size: int) -> np.ndarray:
    return (numbers[:, None] // 3 ** np.arange(size)) % 3


def estimate(
    vote_rows: np.ndarray, counts: np.ndarray, prior: float = 0.15, rounds: int = 200, trust: float = 0.995, strength: float = 0.02,
    unlabelled: float = 0.05,
) -> dict[str, np.ndarray]:
    """Expectation-maximisation over vote patterns; the last labeller is the human one.

    Two classes (good, bad) and, per class and labeller, the chance of each vote. Starts from mostly silent labellers
    whose votes are right nine times out of ten, so that class 1 is the one that bad votes point to, and keeps that
    belief with the weight of ``strength`` of all documents. A human vote is right with chance ``trust``, which is not estimated;
    where there are any, documents without one have the weight ``unlabelled``, as they would outvote the others.
    """
    size = vote_rows.shape[1]
    share = np.array([1 - prior, prior])
    chance = np.empty((2, size, 3))
    chance[0], chance[1] = [0.7, 0.27, 0.03], [0.7, 0.03, 0.27]
    silent = counts[vote_rows[:, -1] == NONE].sum() / max(counts.sum(), 1)
    chance[0, -1] = [silent, (1 - silent) * trust, (1 - silent) * (1 - trust)]
    chance[1, -1] = [silent, (1 - silent) * (1 - trust), (1 - silent) * trust]
    if silent < 1:
        counts = np.where(vote_rows[:, -1] == NONE, unlabelled, 1) * counts
    start, belief = chance.copy(), max(1.0, strength * counts.sum())
    one = np.eye(3)[vote_rows]  # pattern, labeller, vote
    for k in range(rounds):
        # The first round rests on the human votes alone, where there are any.
        post = posterior(vote_rows, share, np.concatenate([np.full((2, size - 1, 3), 1 / 3), chance[:, -1:]], 1) if silent < 1 and not k else chance)
        weight = post * counts[:, None]
        new = np.einsum("pc,plv->clv", weight, one) + belief * share[:, None, None] * start
        new /= new.sum(2, keepdims=True)
        new[:, -1] = start[:, -1]
        share_new = (weight.sum(0) + np.array([1 - prior, prior])) / (counts.sum() + 1)
        done = k and np.abs(new - chance).max() < 1e-9
        chance, share = new, share_new
        if done:
            break
    return {"share": share, "chance": chance}


def posterior(vote_rows: np.ndarray, share: np.ndarray, chance: np.ndarray) -> np.ndarray:
    """Chance of each class for each row of votes."""
    size = vote_rows.shape[1]
    logs = np.log(share)[None, :] + sum(np.log(np.maximum(chance[:, k, :], 1e-12))[:, vote_rows[:, k]].T for k in range(size))
    logs -= logs.max(1, keepdims=True)
    out = np.exp(logs)
    return out / out.sum(1, keepdims=True)


# Figures cut into steps become hashed features beside the words.
_STEPS = {
    "cells": [1, 10, 25, 50, 100, 300, 1000, 5000],
    "symbols": [0.002, 0.01, 0.03, 0.05, 0.1],
    "capitals": [0.03, 0.08, 0.12, 0.2, 0.3, 0.6],
    "repeats": [0.02, 0.05, 0.1, 0.2, 0.3, 0.5],
    "bars": [0.01, 0.05, 0.2, 0.4],
    "lines": [0.01, 0.05, 0.1, 0.3, 0.6],
    "shape": [3, 4, 5, 6, 7, 9, 12],
    "insults": [1, 2, 3],
}


def features(raw: np.ndarray, at: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray, np.ndarray]:
    """Figures and hashed features, each at most once per text, ordered by text."""
    figures, row, code = text_features(raw, at)
    n = len(at) - 1
    rows, buckets = [row], [FIGURES + ((mix(code) >> np.uint64(2)) % np.uint64((1 << BITS) - FIGURES)).astype(np.int64)]
    for k, (name, steps) in enumerate(_STEPS.items()):
        step = np.searchsorted(steps, figures[name], "right")
        rows.append(np.arange(n))
        buckets.append(step.astype(np.int64) + 16 * k)
    keys = np.unique((np.concatenate(rows) << BITS) | np.concatenate(buckets))
    return figures, keys >> BITS, keys & ((1 << BITS) - 1)


def score(weights: np.ndarray, bias: np.ndarray, row: np.ndarray, bucket: np.ndarray, n: int) -> np.ndarray:
    """Chance of bad quality and of toxicity for each text."""
    out = np.empty((n, 2))
    for head in range(2):
        out[:, head] = bias[head] + np.bincount(row, weights[head][bucket], minlength=n)
    return 1 / (1 + np.exp(-np.clip(out, -40, 40)))


def fit(lists: list[np.ndarray], targets: np.ndarray, epochs: int = EPOCHS, rate: float = RATE, least: int = LEAST_DOCUMENTS) -> tuple[np.ndarray, np.ndarray]:
    """Logistic regression by AdaGrad on hashed features with soft targets; two heads, fixed order, no randomness.

    A head learns weights for the steps of figures and for the word features that lean to one class by ``LEAN`` standard
    deviations or more, the ``MOST_FEATURES`` strongest; the rest would only be learnt by heart and keep weight 0.
    """
    size = 1 << BITS
    weights, seen = np.zeros((2, size)), np.full((2, size), 1e-4)
    bias, bias_seen = np.zeros(2), np.full(2, 1e-4)
    every = np.concatenate(lists)
    owner = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
    n = np.bincount(every, minlength=size)
    chosen = np.zeros((2, size), bool)
    for head in range(2):
        share = targets[:, head].mean()
        lean = np.bincount(every, targets[owner, head], minlength=size) - n * share
        lean = np.abs(lean) / np.sqrt(np.maximum(n * share * (1 - share), 1e-9))
        lean[n < least] = 0
        strong = np.argsort(-lean, kind="stable")[:MOST_FEATURES]
        chosen[head][strong[lean[strong] >= LEAN]] = True
        chosen[head][:FIGURES] = True
    used_by_any = chosen.any(0)
    lists = [x[used_by_any[x]] for x in lists]
    for epoch in range(epochs):
        order = np.argsort(mix(np.arange(len(lists), dtype=np.uint64) + np.uint64(epoch << 32)), kind="stable")
        for lo in range(0, len(order), BATCH):
            part = order[lo : lo + BATCH]
            sizes = np.array([len(lists[i]) for i in part])
            bucket = np.concatenate([lists[i] for i in part])
            row = np.repeat(np.arange(len(part)), sizes)
            used, place = np.unique(bucket, return_inverse=True)
            error = score(weights, bias, row, bucket, len(part)) - targets[part]
            for head in range(2):
                slope = np.bincount(place, error[row, head], minlength=len(used)) / len(part)
                slope *= chosen[head][used]
                slope += DECAY * weights[head][used]
                seen[head][used] += slope**2
                weights[head][used] -= rate * slope / np.sqrt(seen[head][used])
            slope = error.mean(0)
            bias_seen += slope**2
            bias -= rate * slope / np.sqrt(bias_seen)
    return weights, bias


def vote_table(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Id and the two vote patterns of every document."""
    schema = T.StructType([
        T.StructField("id", docs.schema[id_col].dataType), T.StructField("quality", T.LongType()), T.StructField("toxic", T.LongType())
    ])

    @task()
    def run(batches):
        for batch in batches:
            parts = [votes(text_features(raw, at)[0]) for _, raw, at in chunks(batch.column(1))]
            for (row, raw, at), (quality, toxic) in zip(chunks(batch.column(1)), parts):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(row, len(at) - 1), pa.array(pattern(quality)), pa.array(pattern(toxic))],
                    ["id", "quality", "toxic"],
                )

    return docs.select(id_col, text_col).mapInArrow(run, schema)


def human_votes(labels: DataFrame, label_id: str) -> DataFrame:
    """Human labels as votes; several labels of one document count as one, the worse; a null label is no vote."""
    human = labels.groupBy(F.col(label_id).alias("id")).agg(F.min("quality").alias("q"), F.max("toxic").alias("t"))
    return human.select(
        "id",
        F.when(F.col("q").isNull(), NONE).when(F.col("q") == 0, BAD).otherwise(GOOD).alias("h_quality"),
        F.when(F.col("t").isNull(), NONE).when(F.col("t") == 1, BAD).otherwise(GOOD).alias("h_toxic"),
    )


def _with_labels(table: DataFrame, labels: DataFrame | None, label_id: str) -> DataFrame:
    if labels is None:
        return table.withColumns({"h_quality": F.lit(NONE), "h_toxic": F.lit(NONE)})
    return table.join(human_votes(labels, label_id), "id", "left").fillna(NONE, ["h_quality", "h_toxic"])


class QualityModel:
    """Weights of the scorer and the estimated labeller tables."""

    def __init__(self, weights: np.ndarray, bias: np.ndarray, quality: dict, toxic: dict):
        self.weights, self.bias, self.quality, self.toxic = weights.astype(np.float32), bias, quality, toxic


def train(
    docs: DataFrame, labels: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text", label_id: str = "doc_id",
    sample_rows: int = SAMPLE_ROWS,
) -> QualityModel:
    """Estimate the labellers over all documents and fit the scorer on about ``sample_rows`` of them."""
    voted = materialize(vote_table(docs, id_col, text_col), "votes")
    counted = _with_labels(voted, labels, label_id).groupBy("quality", "toxic", "h_quality", "h_toxic").count().toPandas()
    total = int(counted["count"].sum()) if len(counted) else 0
    tables = {}
    for head, size in (("quality", len(QUALITY_LABELLERS)), ("toxic", len(TOXIC_LABELLERS))):
        sums = counted.groupby([head, f"h_{head}"])["count"].sum().reset_index()
        rows = np.column_stack([unpack(sums[head].to_numpy(np.int64), size), sums[f"h_{head}"].to_numpy(np.int64)]).astype(np.int64)
        tables[head] = estimate(rows, sums["count"].to_numpy(float))
    sample = materialize(_sample(docs, labels, id_col, text_col, label_id, sample_rows, total), "sample")
    out = sample.repartition(1).sortWithinPartitions("id", "text").mapInArrow(_fit_task(tables), "weights binary, bias binary").collect()
    weights = np.frombuffer(out[0]["weights"], np.float64).reshape(2, -1) if out else np.zeros((2, 1 << BITS))
    bias = np.frombuffer(out[0]["bias"], np.float64) if out else np.zeros(2)
    return QualityModel(weights, bias, tables["quality"], tables["toxic"])


def _sample(docs, labels, id_col, text_col, label_id, sample_rows, total) -> DataFrame:
    """About ``sample_rows`` documents by hash of id, from those with human labels where there are any.

    The labels that the sample needs are as few, so they may be broadcast.
    """
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    known = labels.select(label_id).distinct().count() if labels is not None else 0
    slots = min(_BUCKET, -(-sample_rows * _BUCKET // max(known or total, 1)))
    inside = lambda column: F.pmod(F.xxhash64(column), F.lit(_BUCKET)) < slots
    if not known:
        return texts.filter(inside("id")).withColumns({"h_quality": F.lit(NONE), "h_toxic": F.lit(NONE)})
    return texts.filter(inside("id")).join(F.broadcast(human_votes(labels.filter(inside(label_id)), label_id)), "id")


def _fit_task(tables: dict):
    """Fits the scorer in one task; the sample is bounded, and only hashed features are held."""

    @task()
    def run(batches):
        lists: list[np.ndarray] = []
        soft: list[np.ndarray] = []
        for batch in batches:
            human = np.column_stack([batch.column(2).to_numpy(zero_copy_only=False), batch.column(3).to_numpy(zero_copy_only=False)])
            for first, raw, at in chunks(batch.column(1)):
                n = len(at) - 1
                figures, row, bucket = features(raw, at)
                quality, toxic = votes(figures)
                for k, (name, own) in enumerate((("quality", quality), ("toxic", toxic))):
                    rows = np.column_stack([own, human[first : first + n, k]]).astype(np.int64)
                    post = posterior(rows, tables[name]["share"], tables[name]["chance"])[:, 1]
                    soft.append(post) if k == 0 else soft.__setitem__(-1, np.column_stack([soft[-1], post]))
                lists += np.split(bucket.astype(np.int32), np.searchsorted(row, np.arange(1, n)))
        if lists:
            targets = np.concatenate(soft)
            weights, bias = fit(lists, targets)
            yield pa.RecordBatch.from_arrays(
                [pa.array([weights.tobytes()], pa.binary()), pa.array([bias.tobytes()], pa.binary())], ["weights", "bias"]
            )

    return run


def score_documents(docs: DataFrame, model: QualityModel, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Every row of ``docs`` with ``p_bad``, ``p_toxic`` and ``kept``; columns of these names are replaced."""
    added = ["p_bad", "p_toxic", "kept"]
    rest = docs.drop(*added)
    schema = T.StructType([
        *rest.schema.fields, T.StructField("p_bad", T.DoubleType()), T.StructField("p_toxic", T.DoubleType()), T.StructField("kept", T.BooleanType())
    ])
    shared = docs.sparkSession.sparkContext.broadcast((model.weights, model.bias))

    @task()
    def run(batches):
        weights, bias = shared.value
        for batch in batches:
            index = batch.schema.get_field_index(text_col)
            for first, raw, at in chunks(batch.column(index)):
                n = len(at) - 1
                figures, row, bucket = features(raw, at)
                p = np.round(score(weights, bias, row, bucket, n), 6)
                kept = (p < threshold).all(1) & (figures["cells"] > 0)
                part = batch.slice(first, n)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(p[:, 0]), pa.array(p[:, 1]), pa.array(kept)], [*part.schema.names, *added]
                )

    return rest.mapInArrow(run, schema)


def drop_rejected(docs: DataFrame, model: QualityModel, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that the scorer keeps, columns as they are."""
    schema = docs.schema
    shared = docs.sparkSession.sparkContext.broadcast((model.weights, model.bias))

    @task()
    def run(batches):
        weights, bias = shared.value
        for batch in batches:
            index = batch.schema.get_field_index(text_col)
            for first, raw, at in chunks(batch.column(index)):
                n = len(at) - 1
                figures, row, bucket = features(raw, at)
                p = np.round(score(weights, bias, row, bucket, n), 6)
                yield batch.slice(first, n).filter(pa.array((p < threshold).all(1) & (figures["cells"] > 0)))

    return docs.mapInArrow(run, schema)
