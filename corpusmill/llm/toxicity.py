"""Toxicity by weak supervision: many voters, a generative label model, a linear classifier on its posteriors.

Voters look for words of themed insult lists, for several of them, for insults near an address, for threats and shouting; two
more use lists of terms learned from the given labels, and one speaks for a document in which nothing was found. Learned lists
are cross-fitted: a row is judged by the list of the other half of the labelled rows, so no voter knows a row's own label.

Votes are counted per pattern over all documents (at most 2^voters rows whatever the input). Expectation-maximisation on these
counts and on the votes of the labelled sample, where the label is one more vote of fixed trust, estimates how often each
voter speaks in either class. Voters that depend on each other given the class (lists that overlap, "several" and its lists) are
joined in a forest by their conditional mutual information, and each one's chances then depend on its parent's vote, so
two correlated voters do not count twice. The posteriors are the labels of a logistic regression (Spark ML, L1 penalty) on hashed
words, the first 3 to 6 letters of words, and the fixed voters; it alone scores documents, whole texts, all of them.

The sample is the only bounded part: at most ``sample_rows`` labelled ids, the first ones by hash; where there are no labels,
about as many documents by hash of id, whose posteriors rest on the votes alone. Only its rows and counts of votes are shuffled.

Defined results: null and empty texts have no words; they score like any document in which nothing is found. Equal texts score
equally. A null label is none; of several labels of one id the toxic one counts; of several texts of one id the smallest is
learned from, and all are scored. Without any sample, or where it has one class only, every score is the share of the toxic class
in the label model. An empty table gives an empty table. Columns of ``docs`` stay, ``score``, ``predicted`` and ``voters`` are replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill.llm.arrays import byte_set, chunks, hash_spans, mix, spans, task, texts_of
from corpusmill.session import materialize

BITS = 18
PREFIXES = (3, 4, 5, 6)
SAMPLE_ROWS = 20_000
TERMS = 1_000  # of each learned list
LEAST_TOXIC = 3
LEAST_SHARE = 0.8
THRESHOLD = 0.3
PENALTY = 0.03  # over the square root of the number of rows learned from
ITERATIONS = 60
TRUST = 0.98
_CHUNK = 4 << 20

# Insults by theme in four languages, threats, and words that address the reader.
LISTS = {
    "mind": "idiot idiots moron morons stupid dumb imbecile fool brainless dumm dumme dummkopf blöd trottel crétin imbécile stupide débile abruti idiota imbécil estúpido estúpida tonto tonta",
    "worth": "worthless pathetic loser losers useless failure nobody wertlos versager erbärmlich nutzlos minable raté nullard pitoyable inútil patético patética perdedor perdedora",
    "filth": "trash scum disgusting filth filthy vermin garbage abschaum dreck widerlich ekelhaft ungeziefer ordure dégoûtant racaille déchet vermine basura escoria asqueroso asquerosa",
    "mock": "clown clowns joke ugly creep freak witzfigur hässlich lächerlich bouffon laid ridicule payaso ridículo feo",
    "swear": "shit fuck fucking bastard asshole crap scheiße arschloch mistkerl merde salaud putain connard mierda puta cabrón gilipollas",
    "threat": "kill hurt destroy murder töten umbringen zerstören tuer détruire crever matar destruir",
}
ADDRESS = "you your youre yourself du dich dir dein deine ihr euch tu te toi ton vous votre tú ti eres usted"

VOTERS = [*LISTS, "several", "addressed", "shouting", "learned", "learned_several", "calm"]
FIXED = 9  # the first voters, which need no labels
NO_VOTE, CLEAN, TOXIC = 0, 1, 2

_LETTER = byte_set((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))
_UPPER, _SMALL, _MARK = byte_set((0x41, 0x5A)), byte_set((0x61, 0x7A)), byte_set((0x21, 0x21))
_LEAD = ~byte_set((0x80, 0xBF))


def hash_words(words: list[str]) -> np.ndarray:
    raw, at = texts_of(pa.array([" ".join(words)]))
    starts, ends, _ = spans(raw, at, _LETTER)
    return hash_spans(raw, starts, ends)


class Texts:
    """Words of a run of whole texts: distinct words with their terms, and which text has which of them."""

    def __init__(self, column: pa.Array):
        raw, at = texts_of(column)
        self.n = len(column)

        def per_text(mask):
            total = np.concatenate(([0], np.cumsum(mask[raw], dtype=np.int64)))
            return total[at[1:]] - total[at[:-1]]

        upper, small = per_text(_UPPER), per_text(_SMALL)
        self.shouts = (per_text(_MARK) >= 5) & (upper > small)
        raw, at = texts_of(pc.utf8_lower(column.fill_null("") if column.null_count else column))
        starts, ends, self.row = spans(raw, at, _LETTER)
        codes = hash_spans(raw, starts, ends, fold=False)
        self.words, first, self.place = np.unique(codes, return_index=True, return_inverse=True)
        starts, ends = starts[first], ends[first]
        # Beginnings of the distinct words, cut at whole characters.
        leads = np.append(np.flatnonzero(_LEAD[raw]), len(raw))
        at_lead = np.searchsorted(leads, starts)
        n_letters = np.searchsorted(leads, ends) - at_lead
        terms, owner = [self.words], [np.arange(len(first))]
        for size in PREFIXES:
            long = np.flatnonzero(n_letters >= size)
            terms.append(mix(hash_spans(raw, starts[long], leads[at_lead[long] + size], fold=False) + np.uint64(size)))
            owner.append(long)
        self.terms, self.term_word = np.concatenate(terms), np.concatenate(owner)
        pairs = np.unique(self.row * max(len(first), 1) + self.place)
        self.pair_row, self.pair_word = pairs // max(len(first), 1), pairs % max(len(first), 1)

    def having(self, terms: np.ndarray) -> np.ndarray:
        """Number of distinct words of each text that have one of the given terms."""
        hit = np.bincount(self.term_word, np.isin(self.terms, terms), minlength=len(self.words)) > 0
        return np.bincount(self.pair_row, hit[self.pair_word], minlength=self.n)

    def votes(self, learned: list[np.ndarray], half: np.ndarray) -> np.ndarray:
        """One column of truth values per voter; ``half`` names the learned list of each row."""
        found = [self.having(hash_words(words.split())) for words in LISTS.values()]
        insults = hash_words(" ".join(list(LISTS.values())[:5]).split())
        several = self.having(insults)
        near, address = np.isin(self.words, insults)[self.place], np.isin(self.words, hash_words(ADDRESS.split()))[self.place]
        addressed = np.zeros(self.n, bool)
        for step in (1, 2, 3):
            hit = near[step:] & address[:-step] & (self.row[step:] == self.row[:-step])
            addressed[self.row[step:][hit]] = True
        terms = np.where(half == 0, self.having(learned[0]), self.having(learned[1]))
        n_words = np.bincount(self.row, minlength=self.n)
        calm = (several == 0) & (terms == 0) & ~self.shouts & (n_words >= 10)
        return np.stack([*[x > 0 for x in found], several > 1, addressed, self.shouts, terms > 0, terms > 2, calm], 1)

    def features(self, fixed: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row, bucket and value: distinct words of a text per term bucket, and the fixed voters in the first buckets."""
        bucket = _buckets(self.terms)
        order = np.argsort(self.term_word, kind="stable")
        begin = np.searchsorted(self.term_word[order], np.arange(len(self.words) + 1))
        n = (begin[1:] - begin[:-1])[self.pair_word]
        step = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        own = bucket[order][np.repeat(begin[:-1][self.pair_word], n) + step]
        row, voter = np.nonzero(fixed)
        keys = np.concatenate((np.repeat(self.pair_row, n) << BITS | own, row << BITS | voter))
        keys, value = np.unique(keys, return_counts=True)
        return keys >> BITS, keys & ((1 << BITS) - 1), value

    def score(self, weights: np.ndarray, bias: float, fixed: np.ndarray) -> np.ndarray:
        """The classifier's chance of toxicity: each distinct word has one weight, the sum of those of its terms."""
        own = np.bincount(self.term_word, weights[_buckets(self.terms)], minlength=len(self.words))
        total = bias + np.bincount(self.pair_row, own[self.pair_word], minlength=self.n) + fixed @ weights[:FIXED]
        return 1 / (1 + np.exp(-np.clip(total, -40, 40)))


def _buckets(terms: np.ndarray) -> np.ndarray:
    return (FIXED + (terms >> np.uint64(3)) % np.uint64((1 << BITS) - FIXED)).astype(np.int64)


def pack(votes: np.ndarray) -> np.ndarray:
    return (votes.astype(np.int64) << np.arange(votes.shape[1])).sum(1)


def unpack(patterns: np.ndarray) -> np.ndarray:
    return (np.asarray(patterns, np.int64)[:, None] >> np.arange(len(VOTERS))) & 1


class LabelModel:
    """Class shares, chances of each vote given the class and the parent's vote, and the forest of dependent voters."""

    def __init__(self, share: np.ndarray, chance: np.ndarray, parent: np.ndarray, trust: float):
        self.share, self.chance, self.parent, self.trust = share, chance, parent, trust

    def posterior(self, votes: np.ndarray, human: np.ndarray) -> np.ndarray:
        """Chance of the toxic class for each row of votes; ``human`` is one of no vote, clean, toxic."""
        logs = np.log(np.tile(self.share, (len(votes), 1)))
        for k, parent in enumerate(self.parent):
            given = votes[:, parent] if parent >= 0 else np.zeros(len(votes), np.int64)
            speaks = self.chance[:, k, given].T
            logs += np.log(np.where(votes[:, k : k + 1] > 0, speaks, 1 - speaks))
        right = np.array([[1, 1], [self.trust, 1 - self.trust], [1 - self.trust, self.trust]])
        logs += np.log(right[human])
        return 1 / (1 + np.exp(np.clip(logs[:, 0] - logs[:, 1], -60, 60)))

    def accuracies(self) -> dict[str, tuple[float, float]]:
        """How often each voter speaks in the clean and in the toxic class, its parent silent."""
        return {name: (float(self.chance[0, k, 0]), float(self.chance[1, k, 0])) for k, name in enumerate(VOTERS)}

    def correlated(self) -> list[tuple[str, str]]:
        return [(VOTERS[k], VOTERS[p]) for k, p in enumerate(self.parent) if p >= 0]


def forest(votes: np.ndarray, weight: np.ndarray, least: float = 0.002) -> np.ndarray:
    """Parent of each voter (-1: none): the spanning forest of greatest mutual information given the class."""
    n = votes.shape[1]
    total = weight.sum()
    gain = np.zeros((n, n))
    for c in range(weight.shape[1]):
        w = weight[:, c]
        mass = max(w.sum(), 1e-9)
        both = (votes * w[:, None]).T @ votes
        single = np.diag(both)
        for a, p in ((1, both), (2, single[:, None] - both), (3, single[None, :] - both), (4, mass - single[:, None] - single[None, :] + both)):
            x = single[:, None] if a in (1, 2) else mass - single[:, None]
            y = single[None, :] if a in (1, 3) else mass - single[None, :]
            p = np.maximum(p, 0)
            gain += np.where(p > 1e-9, p * np.log(np.maximum(p, 1e-9) * mass / np.maximum(x * y, 1e-9)), 0) / max(total, 1e-9)
    np.fill_diagonal(gain, 0)
    parent, joined = np.full(n, -1), np.zeros(n, bool)
    for _ in range(n):
        open_ = gain * joined[:, None] * ~joined[None, :]
        p, k = np.unravel_index(open_.argmax(), open_.shape)
        if joined.any() and open_[p, k] >= least:
            parent[k] = p
        else:
            k = int(np.argmin(joined))
        joined[k] = True
    return parent


def estimate(votes: np.ndarray, human: np.ndarray, counts: np.ndarray, prior: float = 0.1, trust: float = TRUST, rounds: int = 100, phases: int = 3) -> LabelModel:
    """Expectation-maximisation over vote patterns, first with independent voters, then along the forest of dependent ones,
    which is drawn again from the better posteriors of each phase.

    The start believes that voters for toxicity speak in 30 percent of toxic and 3 percent of clean rows, and ``calm`` the other
    way round; that belief stays with the weight of one row in a hundred. Where there are human votes, rows without one weigh as much
    as those in all at most, and the first round rests on the human votes alone.
    """
    n, known = votes.shape[1], counts[human != NO_VOTE].sum()
    if known:
        counts = counts * np.where(human == NO_VOTE, min(1.0, known / max(counts[human == NO_VOTE].sum(), 1)), 1.0)
    start = np.empty((2, n, 2))
    start[0], start[1] = 0.03, 0.3
    start[:, VOTERS.index("calm")] = np.array([0.8, 0.2])[:, None]
    believe = max(1.0, 0.01 * counts.sum())
    model = LabelModel(np.array([1 - prior, prior]), start.copy(), np.full(n, -1), trust)
    for phase in range(phases):
        for k in range(rounds):
            if known and not phase and not k:
                post = np.where(human == TOXIC, trust, np.where(human == CLEAN, 1 - trust, prior))
            else:
                post = model.posterior(votes, human)
            weight = np.column_stack([1 - post, post]) * counts[:, None]
            chance = np.empty_like(start)
            for v in range(n):
                given = votes[:, model.parent[v]] if model.parent[v] >= 0 else np.zeros(len(votes), np.int64)
                for value in (0, 1):
                    here = weight * (given == value)[:, None]
                    chance[:, v, value] = (here[votes[:, v] > 0].sum(0) + believe * model.share * start[:, v, value]) / (here.sum(0) + believe * model.share)
            chance = np.clip(chance, 1e-6, 1 - 1e-6)
            share = np.clip((weight.sum(0) + np.array([1 - prior, prior])) / (counts.sum() + 1), 1e-6, 1)
            done = k > 1 and np.abs(chance - model.chance).max() < 1e-7
            model = LabelModel(share, chance, model.parent, trust)
            if done:
                break
        if phase < phases - 1:
            parent = forest(votes, weight)
            # Along a new edge each voter starts with its own chances, whatever the parent says.
            model = LabelModel(model.share, model.chance[:, :, :1].repeat(2, 2), parent, trust)
    return model


class ToxicityModel:
    """The classifier's weights, the learned lists and the label model they were made with."""

    def __init__(self, weights: np.ndarray, bias: float, learned: list[np.ndarray], labels: LabelModel):
        self.weights, self.bias, self.learned, self.labels = weights.astype(np.float32), bias, learned, labels


def _halves(ids: pa.Array) -> np.ndarray:
    """0 or 1 for each id, by hash of its text; a null id is in the first half."""
    raw, at = texts_of(ids.cast(pa.string()))
    full = np.diff(at) > 0
    out = np.zeros(len(ids), np.int64)
    out[full] = (hash_spans(raw, at[:-1][full], at[1:][full], fold=False) & np.uint64(1)).astype(np.int64)
    return out


def _runs(batches, ids: int, texts: int):
    for batch in batches:
        for row, _, at in chunks(batch.column(texts), _CHUNK):
            part = batch.slice(row, len(at) - 1)
            yield part, Texts(part.column(texts)), _halves(part.column(ids))


def _sample(docs: DataFrame, labels: DataFrame | None, id_col: str, text_col: str, label_id: str, label_col: str, sample_rows: int) -> DataFrame:
    """``id``, ``text``, ``human`` of at most ``sample_rows`` labelled ids, or of about as many documents without labels."""
    own = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    known = None
    if labels is not None:
        known = labels.groupBy(F.col(label_id).alias("id")).agg(F.max(label_col).alias("toxic")).filter(F.col("id").isNotNull() & F.col("toxic").isNotNull())
        known = materialize(known.orderBy(F.xxhash64("id"), "id").limit(sample_rows), "labels")
        if known.isEmpty():
            known = None
    if known is not None:
        human = F.when(F.col("toxic") == 1, TOXIC).otherwise(CLEAN).alias("human")
        rows = own.join(F.broadcast(known), "id").select("id", "text", human)  # sample_rows rows at most
    else:
        total = max(docs.count(), 1)
        slots = min(1 << 20, -(-sample_rows * (1 << 20) // total))
        rows = own.filter(F.pmod(F.xxhash64("id"), F.lit(1 << 20)) < slots).withColumn("human", F.lit(NO_VOTE))
    one = rows.groupBy("id").agg(F.min(F.coalesce("text", F.lit(""))).alias("text"), F.first("human").alias("human"))
    return materialize(one, "sample")


def _learned_lists(sample: DataFrame, terms: int) -> list[np.ndarray]:
    """For each half of the rows, the terms that mark toxic rows of the other half best: at most ``terms`` a list."""

    @task()
    def run(batches):
        for part, texts, half in _runs(batches, 0, 1):
            human = np.asarray(part.column(2))
            for h in (0, 1):
                sums = []
                for value in (TOXIC, CLEAN):
                    chosen = (half == h) & (human == value)
                    words = np.bincount(texts.pair_word, chosen[texts.pair_row], minlength=len(texts.words))
                    sums.append(words[texts.term_word].astype(np.int64))
                some = sums[0] > 0
                code, place = np.unique(texts.terms[(sums[0] > 0) | (sums[1] > 0)], return_inverse=True)
                some = (sums[0] > 0) | (sums[1] > 0)
                if len(code):
                    toxic, clean = (np.bincount(place, x[some]).astype(np.int64) for x in sums)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(code), h)), pa.array(code.view(np.int64)), pa.array(toxic), pa.array(clean)], ["half", "term", "toxic", "clean"])

    counted = sample.select("id", "text", "human").mapInArrow(run, "half long, term long, toxic long, clean long")
    sums = counted.groupBy("half", "term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    marks = sums.filter((F.col("toxic") >= LEAST_TOXIC) & (F.col("toxic") >= LEAST_SHARE * (F.col("toxic") + F.col("clean"))))
    strength = F.col("toxic") * F.log((F.col("toxic") + 1.0) / (F.col("clean") + 1.0))
    out = []
    for h in (1, 0):
        best = marks.filter(F.col("half") == h).orderBy(strength.desc(), "term").limit(terms).select("term").collect()
        out.append(np.array([r["term"] for r in best], np.int64).view(np.uint64))
    return out


def _count_votes(docs: DataFrame, id_col: str, text_col: str, learned: list[np.ndarray]):
    """Number of documents of each vote pattern, all documents."""

    @task()
    def run(batches):
        for _, texts, half in _runs(batches, 0, 1):
            pattern, n = np.unique(pack(texts.votes(learned, half)), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(pattern), pa.array(n.astype(np.int64))], ["pattern", "n"])

    rows = docs.select(id_col, text_col).mapInArrow(run, "pattern long, n long").groupBy("pattern").agg(F.sum("n").alias("n")).collect()
    return np.array([r["pattern"] for r in rows], np.int64), np.array([r["n"] for r in rows], float)


_SPARSE = "features struct<type:tinyint,size:int,indices:array<int>,values:array<double>>"


def _training_rows(sample: DataFrame, learned: list[np.ndarray], model: LabelModel) -> DataFrame:
    """A row per class that a sampled document may have: ``label``, ``weight`` (the posterior) and its sparse features."""
    from pyspark.ml.linalg import VectorUDT

    @task()
    def run(batches):
        for part, texts, half in _runs(batches, 0, 1):
            votes = texts.votes(learned, half)
            post = model.posterior(votes.astype(np.int64), np.asarray(part.column(2)))
            row, bucket, value = texts.features(votes[:, :FIXED])
            cut = np.searchsorted(row, np.arange(texts.n + 1)).astype(np.int32)
            vectors = pa.StructArray.from_arrays(
                [
                    pa.array(np.zeros(texts.n, np.int8)), pa.array(np.full(texts.n, 1 << BITS, np.int32)),
                    pa.ListArray.from_arrays(cut, pa.array(bucket.astype(np.int32))), pa.ListArray.from_arrays(cut, pa.array(value.astype(float))),
                ],
                ["type", "size", "indices", "values"],
            )
            for label, weight in ((1.0, post), (0.0, 1 - post)):
                kept = pa.array(np.flatnonzero(weight >= 0.01))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(kept), label)), pa.array(weight).take(kept), vectors.take(kept)], ["label", "weight", "features"])

    written = materialize(sample.select("id", "text", "human").mapInArrow(run, f"label double, weight double, {_SPARSE}"), "features")
    # The same columns as Spark ML's vectors: its sparse type is this struct.
    schema = T.StructType([T.StructField("label", T.DoubleType()), T.StructField("weight", T.DoubleType()), T.StructField("features", VectorUDT())])
    return sample.sparkSession.read.schema(schema).parquet(*written.inputFiles()) if not written.isEmpty() else written


def train(
    docs: DataFrame, labels: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text", label_id: str = "doc_id", label_col: str = "toxic",
    sample_rows: int = SAMPLE_ROWS, terms: int = TERMS, penalty: float = PENALTY, iterations: int = ITERATIONS,
) -> ToxicityModel:
    """Learn the lists, estimate the voters over all documents, and fit the classifier on the sample's posteriors."""
    from pyspark.ml.classification import LogisticRegression

    sample = _sample(docs, labels, id_col, text_col, label_id, label_col, sample_rows)
    learned = _learned_lists(sample, terms)
    patterns, counts = _count_votes(docs, id_col, text_col, learned)

    @task()
    def voted(batches):
        for part, texts, half in _runs(batches, 0, 1):
            yield pa.RecordBatch.from_arrays([pa.array(pack(texts.votes(learned, half))), part.column(2)], ["pattern", "human"])

    known = sample.filter(F.col("human") != NO_VOTE).select("id", "text", "human").mapInArrow(voted, "pattern long, human int").groupBy("pattern", "human").count().collect()
    patterns = np.concatenate((patterns, np.array([r["pattern"] for r in known], np.int64)))
    human = np.concatenate((np.zeros(len(counts), np.int64), np.array([r["human"] for r in known], np.int64)))
    counts = np.concatenate((counts, np.array([r["count"] for r in known], float)))
    if not len(counts):
        patterns, human, counts = np.zeros(1, np.int64), np.zeros(1, np.int64), np.zeros(1)
    model = estimate(unpack(patterns), human, counts)

    rows = _training_rows(sample, learned, model)
    weights = {r["label"]: r["weight"] for r in rows.groupBy("label").agg(F.sum("weight").alias("weight")).collect()}
    if len(weights) < 2:
        share = float(model.share[1])
        return ToxicityModel(np.zeros(1 << BITS), float(np.log(share / (1 - share))), learned, model)
    fitted = LogisticRegression(
        weightCol="weight", regParam=penalty / float(np.sqrt(sum(weights.values()))), elasticNetParam=1.0, standardization=False, maxIter=iterations, family="binomial", aggregationDepth=2
    ).fit(rows)
    return ToxicityModel(fitted.coefficients.toArray(), float(fitted.intercept), learned, model)


def score_documents(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Every row of ``docs`` with ``score``, ``predicted`` and the names of the ``voters`` that spoke for toxicity."""
    added = [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType()), T.StructField("voters", T.ArrayType(T.StringType()))]
    rest = docs.drop(*[f.name for f in added])
    schema = T.StructType([*rest.schema.fields, *added])
    ids, texts_at = rest.columns.index(id_col), rest.columns.index(text_col)
    shared = docs.sparkSession.sparkContext.broadcast((model.weights, model.bias, model.learned))
    names = np.array(VOTERS[:-1], object)

    @task()
    def run(batches):
        weights, bias, learned = shared.value
        for part, texts, half in _runs(batches, ids, texts_at):
            votes = texts.votes(learned, half)
            p = np.round(texts.score(weights, bias, votes[:, :FIXED].astype(float)), 6)
            row, voter = np.nonzero(votes[:, :-1])
            cut = np.searchsorted(row, np.arange(texts.n + 1)).astype(np.int32)
            spoke = pa.ListArray.from_arrays(cut, pa.array(names[voter], pa.string()))
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(p), pa.array((p >= threshold).astype(np.int32)), spoke], [*part.schema.names, *[f.name for f in added]])

    return rest.mapInArrow(run, schema)
