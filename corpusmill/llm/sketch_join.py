"""N-gram Jaccard join by parity sketches, and the components of its links.

A document's set is its distinct shingles. Two sets with similarity of at least ``similarity`` differ in at most
``k = (a + b) * (1 - s) / (1 + s)`` elements. All elements of a set are dealt to ``B > k`` blocks by hash, and each block
is XORed to one number: an element more or less changes one block only, so of two similar sets at least ``B - k`` blocks
are equal (pigeonhole). Documents that share the value of a block meet; nothing else is compared.

* Sizes are banded by powers of two. A band has its own ``B``; sets near a border also take part in the border's band,
  so every pair that can be similar has a band in common.
* A block without elements says nothing and is not used. The guarantee then needs fewer empty blocks than ``B - k`` in
  one of the two sets. A set with too many deals its elements again by another hash, until a deal has few enough; it
  takes part in all deals up to that one. For any pair the earlier of the two last deals holds for both.
* A second, 512-bit parity sketch travels with each set; its Hamming distance is a lower bound of the difference, and
  drops candidates before any set is read. A wider one, read first and alone, does so for large sets before whole sets are.
* One shared block makes no link: the same count says how many blocks a set must share with a similar one, hundreds where
  sets are large. A set with fewer blocks in buckets of several components has no link left and meets nobody there, so
  passages that many long texts have in common do not make pairs of all of them.

Sets with equal elements are one class and are compared once. Blocks of equal value form a bucket. The first pass only
ties each member to the bucket's hub; a class is verified against one of the hubs it shares most blocks with, and verified
links give components. The second pass looks at buckets that still hold several components and compares members of
different ones, once for all buckets with the same members, and blockwise where a bucket is large. It runs twice: first
only the closest candidates that tie the components together in a few forests are verified, so that a group of thousands
of near copies grows together by a few links each; then every candidate that is left between different components is.
So pairs within a component are never formed, yet no link between components is missed.

Hot keys: equal blocks are folded within each map task, so a bucket gets at most one row per input batch; numbers are
shuffled as packed arrays. Verification reads the sets of candidate classes only, and sends each straight to its pairs.

Defined results: null and texts without words have an empty set, ``n_shingles`` 0 and themselves as component. Rows with
equal ids count as separate rows with that id; a null id takes part with the others of its class and never names a
component unless it is alone. Hashes have 64 bits; two different sets with one class hash stop the job.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill.llm.arrays import NOT_SPACE, chunks, hash_spans, mix, release, shingles, spans, task
from corpusmill.llm.components import connected
from corpusmill.session import materialize

SHINGLE = 5
SIMILARITY = (80, 100)
SKETCH_BITS = 512
BUCKET_KEYS = 250_000  # block values in one shuffled bucket
FOLD_KEYS = 400_000  # block values folded at a time in a map task
UNIT_ROWS = 20_000  # members that one comparing task call gets
COMPARE = 2_048  # members compared with each other in one unit of a large bucket
WIDE_BITS = 8_192
BITS_EACH, MOST_BITS = 64, 1 << 27  # bitmaps of wanted rows: at most 16 MB
HUBS = 3  # hubs that a member tries before the crossing pairs
FORESTS = 3  # forests of candidates verified before all that are left
VERIFY = 64  # members verified against one hub in one unit

_LANES = SKETCH_BITS // 64


def most_difference(total, similarity=SIMILARITY):
    """Largest difference of two similar sets whose sizes add up to ``total``."""
    part, whole = similarity
    return total * (whole - part) // (whole + part)


def sets_of(raw: np.ndarray, at: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes and the text index of each, ordered by text and hash."""
    starts, ends, row = spans(raw, at, NOT_SPACE)
    return shingles(hash_spans(raw, starts, ends), row, len(at) - 1, size)


def _sum_by_row(values: np.ndarray, row: np.ndarray, n: int) -> np.ndarray:
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)))
    at = np.searchsorted(row, np.arange(n + 1))
    return total[at[1:]] - total[at[:-1]]


def class_hashes(values: np.ndarray, row: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Size of each set and two independent 64-bit hashes of it."""
    sizes = np.bincount(row, minlength=n)
    one = mix(_sum_by_row(mix(values), row, n) + sizes.astype(np.uint64))
    two = mix(_sum_by_row(mix(values ^ np.uint64(0xC2B2AE3D27D4EB4F)), row, n))
    return sizes, one, two


def parity_sketch(values: np.ndarray, row: np.ndarray, n: int) -> np.ndarray:
    """Each element flips one of the sketch's bits: ``n`` rows of 64-bit lanes."""
    bit = (mix(values ^ np.uint64(0x165667B19E3779F9)) % np.uint64(SKETCH_BITS)).astype(np.int64)
    odd = np.bincount(row * SKETCH_BITS + bit, minlength=n * SKETCH_BITS) & 1
    return np.packbits(odd.astype(np.uint8).reshape(n, SKETCH_BITS), axis=1, bitorder="little").view(np.uint64)


def bands(sizes: np.ndarray, similarity=SIMILARITY) -> list[tuple[np.ndarray, int, int, int]]:
    """The bands that the sets take part in: (indexes of sets, name of the band, most difference in it, blocks).

    Blocks beyond the difference are chosen so that the smallest sets of a band rarely have too many empty ones.
    """
    part, whole = similarity
    out = []
    level = np.where(sizes > 0, np.floor(np.log2(np.maximum(sizes, 1))).astype(int), -1)
    for j in np.unique(level[level >= 0]):
        top = 1 << (int(j) + 1)
        k = int(most_difference(2 * (top - 1), similarity))
        out.append((np.flatnonzero(level == j), 2 * int(j), k, k + 1 + k // 4 + (k > 0)))
    for j in range(1, int(level.max(initial=0)) + 2):
        border = 1 << j
        # a < border <= b with part * b <= whole * a
        near = np.flatnonzero((whole * sizes >= part * border) & (part * sizes <= whole * (border - 1)))
        if len(near):
            most = border - 1 + whole * (border - 1) // part
            k = int(most_difference(most, similarity))
            out.append((near, 2 * j + 1, k, k + 1 + k // 10 + (k > 0)))
    return out


def least_shared(sizes: np.ndarray, similarity=SIMILARITY) -> np.ndarray:
    """Fewest keys that a set of each size shares with any similar set, whatever the band in which they meet.

    In the deal that holds for a pair one set has fewer than ``blocks - most`` empty blocks, and at most ``difference`` blocks
    differ; so more than ``most - difference`` blocks are equal and not empty. Two fewer are asked for, as keys of 40 bits may
    fall together.
    """
    part, whole = similarity
    least = np.full(len(sizes), np.iinfo(np.int64).max)
    for members, name, most, _ in bands(sizes, similarity):
        n = sizes[members]
        partner = n * whole // part
        if name % 2:  # a border: the smaller set lies below it
            border = 1 << name // 2
            partner = np.where(n < border, partner, border - 1)
        else:
            partner = np.minimum(partner, (2 << name // 2) - 1)
        least[members] = np.minimum(least[members], most - most_difference(n + partner, similarity) + 1)
    return np.maximum(least - 2, 1)


def block_keys(values: np.ndarray, row: np.ndarray, n: int, similarity=SIMILARITY) -> tuple[np.ndarray, np.ndarray]:
    """Hashed (band, deal, block, parity) of every non-empty block: key, text index."""
    sizes = np.bincount(row, minlength=n)
    at = np.searchsorted(row, np.arange(n + 1))
    keys, owners = [], []
    for members, name, most, blocks in bands(sizes, similarity):
        deal = 0
        while len(members):
            place = np.repeat(np.arange(len(members)), sizes[members])
            index = np.concatenate([np.arange(at[m], at[m + 1]) for m in members])
            salt = mix(np.array([name * 1_000 + deal + 1], np.uint64))[0]
            spread = mix(values[index] ^ salt)
            block = ((spread >> np.uint64(32)) % np.uint64(blocks)).astype(np.int64)
            slot = place * blocks + block
            order = np.argsort(slot, kind="stable")
            slot = slot[order]
            head = np.flatnonzero(np.concatenate(([True], slot[1:] != slot[:-1])))
            parity = np.bitwise_xor.reduceat(mix(spread + np.uint64(1))[order], head)
            slot = slot[head]
            keys.append(mix(parity ^ mix((slot % blocks).astype(np.uint64) ^ salt)))
            owners.append(members[slot // blocks])
            full = np.bincount(slot // blocks, minlength=len(members))
            members = members[blocks - full >= blocks - most]
            deal += 1
    if not keys:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(keys), np.concatenate(owners)


def star(keys: np.ndarray, members: np.ndarray) -> tuple[np.ndarray, np.ndarray, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Distinct (key, hub) with the smallest member as hub, and (key, member, hub) for the others."""
    order = np.lexsort((members, keys))
    keys, members = keys[order], members[order]
    if not len(keys):
        return keys, members, (keys, members, members)
    new_key = np.concatenate(([True], keys[1:] != keys[:-1]))
    new = new_key | np.concatenate(([True], members[1:] != members[:-1]))
    hub = members[np.flatnonzero(new_key)][np.cumsum(new_key) - 1]
    rest = new & ~new_key
    return keys[new_key], members[new_key], (keys[rest], members[rest], hub[rest])


def set_table(docs: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """Per row: id, size of its set, class hash, check hash and the parity sketch."""
    names = ["id_", "n", "class", "check", *(f"s{i}" for i in range(_LANES))]
    schema = T.StructType([T.StructField("id_", docs.schema[id_col].dataType), *(T.StructField(c, T.LongType()) for c in names[1:])])

    @task()
    def run(batches):
        for batch in batches:
            for first, raw, at in chunks(batch.column(1)):
                n = len(at) - 1
                values, row = sets_of(raw, at, shingle)
                sizes, one, two = class_hashes(values, row, n)
                lanes = parity_sketch(values, row, n).view(np.int64)
                columns = [pa.array(x) for x in (sizes, one.view(np.int64), two.view(np.int64), *(np.ascontiguousarray(lanes[:, i]) for i in range(_LANES)))]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, n), *columns], names)

    return docs.select(id_col, text_col).mapInArrow(run, schema)


def _packed(keys: np.ndarray, *others: np.ndarray) -> bytes:
    """Arrays of 64-bit numbers as bytes, the first one cut to 40 bits.

    Within a bucket of bounded size so few bits tell keys apart; where they do not, verification does.
    """
    return b"".join([(keys & _LOW).astype(np.uint32).tobytes(), (keys >> np.uint64(32)).astype(np.uint8).tobytes(), *(x.tobytes() for x in others)])


def _unpacked(data: bytes, parts: int) -> np.ndarray:
    n = len(data) // (5 + 8 * (parts - 1))
    out = np.empty((parts, n), np.uint64)
    out[0] = np.frombuffer(data, np.uint32, n) | (np.frombuffer(data, np.uint8, n, 4 * n).astype(np.uint64) << np.uint64(32))
    for k in range(1, parts):
        out[k] = np.frombuffer(data[5 * n + 8 * n * (k - 1) : 5 * n + 8 * n * k], np.uint64)
    return out


_LOW = np.uint64(0xFFFFFFFF)
_KEY_BITS = np.uint64(40)


def bucket_rows(docs: DataFrame, text_col: str, shingle: int, similarity, n_buckets: int) -> DataFrame:
    """Packed (key, hub) arrays by bucket, folded some texts at a time; what was folded goes along as (key, member, hub)."""

    def folded_rows(keys: list[np.ndarray], members: list[np.ndarray]) -> pa.RecordBatch:
        hub_keys, hubs, rest = star(np.concatenate(keys), np.concatenate(members))
        where, kind, data = [], [], []
        for number, columns in enumerate(((hub_keys, hubs), rest)):
            # The high bits name the bucket, the low ones the key in it.
            bucket = ((columns[0] >> _KEY_BITS) % np.uint64(n_buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            bucket, columns = bucket[order], [c[order] for c in columns]
            names, begin = np.unique(bucket, return_index=True)
            for name, lo, hi in zip(names, begin, np.append(begin[1:], len(bucket))):
                where.append(int(name))
                kind.append(number)
                data.append(_packed(*(c[lo:hi] for c in columns)))
        return pa.RecordBatch.from_arrays(
            [pa.array(where, pa.int64()), pa.array(kind, pa.int32()), pa.array(data, pa.binary())], ["bucket", "kind", "data"]
        )

    @task()
    def run(batches):
        for batch in batches:
            keys, members, held = [], [], 0
            for _, raw, at in chunks(batch.column(0)):
                n = len(at) - 1
                values, row = sets_of(raw, at, shingle)
                _, one, _ = class_hashes(values, row, n)
                # Equal sets emit once per chunk.
                first = np.zeros(n, bool)
                first[np.unique(one, return_index=True)[1]] = True
                lead = first[row]
                found, owner = block_keys(values[lead], row[lead], n, similarity)
                keys.append(found)
                members.append(one[owner])
                held += len(found)
                if held >= FOLD_KEYS:
                    yield folded_rows(keys, members)
                    keys, members, held = [], [], 0
            if held:
                yield folded_rows(keys, members)

    return docs.select(text_col).mapInArrow(run, "bucket long, kind int, data binary")


def _ties(table: pa.Table) -> pa.Table:
    """(key, member, hub) of the keys with several members, of a bucket's folded rows or of what one fold left."""
    bucket = np.uint64(table.column("bucket")[0].as_py())
    kinds = table.column("kind").to_numpy()
    data = table.column("data").to_pylist()
    done = [_unpacked(d, 3) for d, k in zip(data, kinds) if k == 1]
    whole = [_unpacked(d, 2) for d, k in zip(data, kinds) if k == 0]
    if whole:
        _, _, rest = star(*np.concatenate(whole, 1))
        done.append(np.stack(rest))
    out = np.concatenate(done, 1)
    keys = mix(out[0] | (bucket << _KEY_BITS))
    return pa.table({"key": keys.view(np.int64), "member": out[1].view(np.int64), "hub": out[2].view(np.int64)})


def tie_rows(rows: DataFrame) -> DataFrame:
    """(key, member, hub) of the rows of ``bucket_rows``.

    Only the folded (key, hub) rows of a bucket must meet in one group. What a fold left is done, and is unpacked apart,
    so that the members of a hot key do not land in one task.
    """
    apart = F.when(F.col("kind") == 1, F.xxhash64("data")).otherwise(F.lit(0))
    return rows.withColumn("apart", apart).groupBy("bucket", "apart").applyInArrow(_ties, "key long, member long, hub long")


def _lanes(prefix: str) -> list[Column]:
    return [F.col(f"{prefix}.s{i}") for i in range(_LANES)]


def may_be_similar(a: str, b: str, similarity=SIMILARITY) -> Column:
    """Sizes and sketches of two aliased class tables allow a link."""
    part, whole = similarity
    distance = sum((F.bit_count(x.bitwiseXOR(y)) for x, y in zip(_lanes(a), _lanes(b))), F.lit(0))
    n, m = F.col(f"{a}.n"), F.col(f"{b}.n")
    return (whole * n >= part * m) & (whole * m >= part * n) & ((whole + part) * distance <= (whole - part) * (n + m))


def verify(pairs: DataFrame, classes: DataFrame, docs: DataFrame, id_col: str, text_col: str, shingle: int, similarity) -> DataFrame:
    """Of (member, hub) class pairs, those whose sets are similar, by the sets themselves.

    Wide sketches go first; only the pairs they leave have their sets read. A hub's set is sent once to each unit of about
    ``VERIFY`` members, so no task holds more than one unit and two sets.
    """
    rows = docs.select(F.xxhash64(id_col).alias("row"), F.col(text_col).alias("text"))
    part, whole = similarity

    def sketches_fit(a: np.ndarray, b: np.ndarray) -> bool:
        distance = int(np.bitwise_count(a[1:] ^ b[1:]).sum())
        return (whole + part) * distance <= (whole - part) * int(a[0] + b[0])

    def sets_fit(a: np.ndarray, b: np.ndarray) -> bool:
        common = len(np.intersect1d(a, b, assume_unique=True))
        return whole * common >= part * (len(a) + len(b) - common)

    unit = F.pmod(F.xxhash64("member"), F.col("units"))
    units = pairs.groupBy("hub").agg(F.ceil(F.count(F.lit(1)) / VERIFY).alias("units"))
    sized = pairs.join(units, "hub").select("member", "hub", unit.alias("unit"))
    possible = materialize(_compared(sized, classes, rows, shingle, wide_sketch, sketches_fit), "possible_pairs")
    return _compared(possible, classes, rows, shingle, np.ndarray.tobytes, sets_fit).select("member", "hub")


def _compared(sized: DataFrame, classes: DataFrame, rows: DataFrame, shingle: int, form, fit) -> DataFrame:
    """The pairs (member, hub, unit) whose sets, in the given form, fit; a unit is one hub and about ``VERIFY`` members.

    Only the texts of classes in a pair are read again, one text a class, and each set goes from there to its units.
    """
    hubs = sized.select("hub", "unit").distinct().select(F.col("hub").alias("class"), "hub", "unit", F.lit(None).cast("long").alias("member"))
    sides = sized.select(F.col("member").alias("class"), "hub", "unit", "member").union(hubs)
    wanted = materialize(classes.join(sides, "class", "left_semi").select("class", F.xxhash64("first").alias("row")), "wanted")
    n = wanted.count()
    # Copies of a wanted text may come along; one row a class is enough.
    held = _held_sets(rows, shingle, bitmap(wanted, "row", n), bitmap(wanted, "class", n), form).dropDuplicates(["class"])

    def run(table: pa.Table) -> pa.Table:
        release()
        names = table.column("member").to_pylist()
        data = [np.frombuffer(x, np.uint64) for x in table.column("data").to_pylist()]
        hub = next((d for n, d in zip(names, data) if n is None), None)
        good = [n for n, d in zip(names, data) if n is not None and hub is not None and fit(hub, d)]
        same = {n: pa.array(table.column(n).to_pylist()[:1] * len(good), pa.int64()) for n in ("hub", "unit")}
        return pa.table({"member": pa.array(good, pa.int64()), **same})

    sent = sides.join(held, "class").select("hub", "unit", "member", "data")
    return sent.groupBy("hub", "unit").applyInArrow(run, "member long, hub long, unit long")


def bitmap(table: DataFrame, column: str, rows: int) -> np.ndarray:
    """Bits of a column of numbers, about ``BITS_EACH`` for each of the ``rows`` rows but never more than ``MOST_BITS`` in all.

    Says for certain that a number is not in the column. Beyond the bound it fills up and excludes less.
    """
    bits = 64
    while bits < min(MOST_BITS, BITS_EACH * rows):
        bits *= 2
    bit = F.pmod(F.col(column), F.lit(bits))
    words = table.select(F.shiftright(bit, 6).alias("word"), F.expr(f"shiftleft(1L, cast(pmod({column}, 64) as int))").alias("mask"))
    found = words.groupBy("word").agg(F.bit_or("mask").alias("mask")).toPandas()
    out = np.zeros(bits // 64, np.uint64)
    out[found["word"].to_numpy(np.int64)] = found["mask"].to_numpy(np.int64).view(np.uint64)
    return out


def may_hold(bits: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    place = numbers.view(np.uint64) % np.uint64(64 * len(bits))
    return (bits[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1) == 1


def _held_sets(rows: DataFrame, shingle: int, row_bits: np.ndarray, class_bits: np.ndarray, form) -> DataFrame:
    """Class and set, packed by ``form``, of the rows that the two bitmaps let pass; sets that nobody asked for may come along.

    Texts stay where they are: joining them with the wanted ids would shuffle every text.
    """
    shared = rows.sparkSession.sparkContext.broadcast((row_bits, class_bits))

    @task()
    def run(batches):
        row_bits, class_bits = shared.value
        for batch in batches:
            batch = batch.filter(pa.array(may_hold(row_bits, batch.column(0).to_numpy())))
            for _, raw, at in chunks(batch.column(1)):
                n = len(at) - 1
                values, row = sets_of(raw, at, shingle)
                _, one, _ = class_hashes(values, row, n)
                ends = np.searchsorted(row, np.arange(n + 1))
                asked = np.flatnonzero(may_hold(class_bits, one))
                data = [form(values[ends[i] : ends[i + 1]]) for i in asked]
                yield pa.RecordBatch.from_arrays([pa.array(one[asked].view(np.int64)), pa.array(data, pa.binary())], ["class", "data"])

    return rows.mapInArrow(run, "class long, data binary")


def wide_sketch(values: np.ndarray) -> bytes:
    """The set's size and a parity sketch of ``WIDE_BITS``, for sets that fill the narrow one."""
    bit = (mix(values ^ np.uint64(0x27220A95FE7D1A05)) % np.uint64(WIDE_BITS)).astype(np.int64)
    odd = (np.bincount(bit, minlength=WIDE_BITS) & 1).astype(np.uint8)
    return np.uint64(len(values)).tobytes() + np.packbits(odd).tobytes()


def _root(parent: list[int], node: int) -> int:
    while parent[node] != node:
        parent[node] = parent[parent[node]]
        node = parent[node]
    return node


def _tying(a: np.ndarray, b: np.ndarray, trees: list[list[int]]) -> list[int]:
    """Indexes of the pairs that join two trees of one of the forests, which grow by them."""
    kept = []
    for k, (x, y) in enumerate(zip(a.tolist(), b.tolist())):
        for parent in trees:
            one, two = _root(parent, x), _root(parent, y)
            if one != two:
                parent[one] = two
                kept.append(k)
                break
    return kept


def _across(table: pa.Table, similarity, forests: int | None) -> pa.Table:
    """Members of one unit that may be similar and are in different components; for many units at once.

    Rows are ordered by unit, and each is held against the next, the second next and so on, all units in step. In a unit
    of two parts only members of different parts meet. With ``forests``, a pair is left out if each of that many forests
    over the components, built by the pairs so far, ties its two components already.
    """
    part, whole = similarity
    col = {n: table.column(n).to_numpy() for n in ("key", "i", "j", "side", "member", "comp", "n")}
    order = np.lexsort((col["side"], col["j"], col["i"], col["key"]))
    col = {n: x[order] for n, x in col.items()}
    sketch = np.stack([table.column(f"s{i}").to_numpy()[order] for i in range(_LANES)], 1).view(np.uint64)
    new = np.ones(len(order), bool)
    new[1:] = (np.diff(col["key"]) != 0) | (np.diff(col["i"]) != 0) | (np.diff(col["j"]) != 0)
    begin = np.flatnonzero(new)
    end = np.append(begin[1:], len(order))[np.cumsum(new) - 1]
    names, comp = np.unique(col["comp"], return_inverse=True)
    trees = [list(range(len(names))) for _ in range(forests or 0)]
    tree, tried = comp, 0  # the tree of each row in the last forest, as of some steps ago
    found = []
    left, step = np.arange(len(order)), 1
    while len(left := left[left + step < end[left]]):
        a, b = left, left + step
        n, m = col["n"][a], col["n"][b]
        fit = (tree[a] != tree[b]) & (whole * m >= part * n) & (whole * n >= part * m)
        fit &= (col["i"][a] == col["j"][a]) | (col["side"][a] != col["side"][b])
        a, b = a[fit], b[fit]
        distance = np.bitwise_count(sketch[a] ^ sketch[b]).sum(1, dtype=np.int64)
        total = col["n"][a] + col["n"][b]
        near = np.flatnonzero((whole + part) * distance <= (whole - part) * total)
        if trees:
            near = near[np.argsort(distance[near] / total[near], kind="stable")]
            near, tried = near[_tying(comp[a[near]], comp[b[near]], trees)], tried + len(near)
            if tried >= len(names):
                tree, tried = np.array([_root(trees[-1], x) for x in range(len(names))])[comp], 0
        found.append(np.stack([col["member"][a[near]], col["member"][b[near]]], 1))
        step += 1
    pairs = np.sort(np.concatenate(found), axis=1) if found else np.zeros((0, 2), np.int64)
    pairs = np.unique(pairs, axis=0)
    return pa.table({"member": pairs[:, 1], "hub": pairs[:, 0]})


def sharing(rows: DataFrame, keys: Column, classes: DataFrame, similarity) -> DataFrame:
    """The rows of members that are in as many mixed buckets, by the aggregate ``keys``, as a link needs.

    All buckets of two linked classes in different components are mixed, so a member with fewer has no such link.
    """
    counts = rows.groupBy("member").agg(keys.alias("keys")).join(classes.select(F.col("class").alias("member"), "n"), "member")

    @task()
    def run(batches):
        for batch in batches:
            least = least_shared(batch.column("n").to_numpy(), similarity)
            yield batch.filter(pa.array(batch.column("keys").to_numpy() >= least)).select(["member"])

    return rows.join(counts.mapInArrow(run, "member long"), "member", "left_semi")


def mixed_buckets(ties: DataFrame, comps: DataFrame, classes: DataFrame, similarity) -> DataFrame:
    """(key, home, parts, same, member) of the buckets that hold several components, one of all ``same`` with the same members."""
    member = comps.select(F.col("class").alias("member"), F.col("root").alias("mc"))
    hub = comps.select(F.col("class").alias("hub"), F.col("root").alias("hc"))
    mixed = ties.join(member, "member").join(hub, "hub").filter("mc <> hc").select("key").distinct()
    rows = ties.join(mixed, "key", "left_semi")
    inside = rows.select("key", "member").union(rows.select("key", F.col("hub").alias("member"))).distinct()
    inside = materialize(sharing(materialize(inside, "mixed"), F.count(F.lit(1)), classes, similarity), "sharing")
    hashed = F.xxhash64("member")
    buckets = inside.groupBy("key").agg(
        F.count(F.lit(1)).alias("size"), F.min("member").alias("first"),
        F.bit_xor(hashed).alias("mark"), F.bit_xor(F.xxhash64(hashed, F.lit(1))).alias("mark2"),
    ).filter("size > 1")
    # Buckets with the same members ask for the same pairs; one of them is enough.
    buckets = buckets.groupBy("size", "first", "mark", "mark2").agg(F.min("key").alias("key"), F.count(F.lit(1)).alias("same"))
    buckets = materialize(buckets.select("key", "size", "first", "same", F.ceil(F.col("size") / COMPARE).alias("parts")), "buckets")
    # Buckets with the same first member stay together, up to a number of rows, for a pair tends to share many of them.
    heads = buckets.groupBy("first").agg(F.ceil(F.sum(F.col("size") * F.col("parts")) / UNIT_ROWS).alias("shares"))
    home = buckets.join(heads, "first").select("key", "parts", "same", F.xxhash64("first", F.pmod(F.xxhash64("key"), F.col("shares"))).alias("home"))
    return materialize(inside.join(home, "key").select("key", "home", "parts", "same", "member"), "dealt")


def still_mixed(dealt: DataFrame, comps: DataFrame, classes: DataFrame, similarity) -> DataFrame:
    """The rows of ``mixed_buckets`` whose buckets hold several of the components there are by now.

    Components only grow together, so a bucket that held one before still does.
    """
    root = comps.select(F.col("class").alias("member"), "root")
    keys = dealt.select("key", "member").join(root, "member").groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high"))
    left = dealt.join(materialize(keys.filter("low <> high").select("key"), "mixed"), "key", "left_semi")
    return materialize(sharing(left, F.sum("same"), classes, similarity), "sharing")


def cross_pairs(dealt: DataFrame, comps: DataFrame, classes: DataFrame, similarity, forests: int | None = None) -> DataFrame:
    """Candidate pairs of different components from ``mixed_buckets``: all, or those of some forests."""
    lanes = [f"s{i}" for i in range(_LANES)]
    info = classes.join(comps, "class").select(F.col("class").alias("member"), F.col("root").alias("comp"), "n", *lanes)
    rows = dealt.agg(F.sum("parts")).first()[0] or 0
    dealt = dealt.join(info, "member").withColumn("part", F.pmod(F.xxhash64("member"), F.col("parts")))
    # Each part meets itself and every other part once: unit (i, j) with i <= j, its members on side 0 (i) or 1 (j).
    units = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))).select(
        "key", "home", "member", "comp", "n", *lanes,
        F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"),
        (F.col("part") > F.col("other")).cast("int").alias("side"),
    )
    # Small units share a call; a unit is never split, and has at most two parts.
    slots = F.pmod(F.xxhash64("home", "i", "j"), F.lit(max(1, rows // UNIT_ROWS)))
    compared = units.groupBy(slots.alias("slot")).applyInArrow(lambda t: _across(t, similarity, forests), "member long, hub long")
    return compared.distinct()


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, similarity: tuple[int, int] = SIMILARITY,
) -> DataFrame:
    """Per row: ``id_col``, ``n_shingles``, ``component_id`` (smallest id reachable by links) and ``n_copies``, the rows
    with an equal set, itself included."""
    docs = docs.select(id_col, text_col)
    found = materialize(set_table(docs, id_col, text_col, shingle), "sets_of_rows")
    classes = found.filter("n > 0").groupBy("class").agg(
        F.min("id_").alias("first"), F.min("n").alias("n"), F.count(F.lit(1)).alias("n_copies"),
        F.min("check").alias("low"), F.max("check").alias("high"), *[F.min(f"s{i}").alias(f"s{i}") for i in range(_LANES)],
    )
    classes = materialize(classes, "classes")
    clash, total = classes.agg(F.count_if(F.col("low") != F.col("high")), F.sum(F.col("n") * F.col("n_copies"))).first()
    if clash:
        raise ValueError(f"{clash} class hashes stand for several sets")
    roots = _components(docs, classes, int(total or 0), id_col, text_col, shingle, similarity)
    smallest = classes.join(roots, "class").groupBy("root").agg(F.min("first").alias("smallest"))
    named = classes.join(roots, "class").join(smallest, "root").select("class", "n_copies", "smallest")
    return found.join(named, "class", "left").select(
        F.col("id_").alias(id_col),
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("smallest")).otherwise(F.col("id_")).alias("component_id"),
        F.when(F.col("n") > 0, F.col("n_copies")).otherwise(F.lit(1)).cast("long").alias("n_copies"),
    )


def _components(docs, classes, total, id_col, text_col, shingle, similarity) -> DataFrame:
    """(class, root) of every class."""
    n_buckets = max(1, -(-total * 6 // (10 * BUCKET_KEYS)))
    ties = materialize(
        tie_rows(bucket_rows(docs, text_col, shingle, similarity, n_buckets)), "ties",
    )
    pairs = ties.groupBy("member", "hub").count()
    # A member tries the hubs it shares most blocks with; what they miss is left to the crossing pairs.
    rank = F.row_number().over(Window.partitionBy("member").orderBy(F.desc("count"), "hub"))
    pairs = pairs.withColumn("rank", rank).filter(F.col("rank") <= HUBS)
    near = _with_sketches(pairs, classes).filter(may_be_similar("a", "b", similarity)).select("member", "hub", "count")
    best = near.groupBy("member").agg(F.max_by("hub", F.struct("count", "hub")).alias("hub"))
    proof = lambda p, name: materialize(verify(p, classes, docs, id_col, text_col, shingle, similarity), name)
    links = proof(materialize(best, "first_pairs"), "first_links")
    roots = materialize(_roots(classes, links), "first_roots")
    dealt = mixed_buckets(ties, roots, classes, similarity)
    for forests in (FORESTS, None):
        dealt = dealt if forests else still_mixed(dealt, roots, classes, similarity)
        crossing = materialize(cross_pairs(dealt, roots, classes, similarity, forests), "crossing_pairs")
        if crossing.isEmpty():
            break
        # A class and its root stand for all earlier links.
        links = roots.filter("class <> root").select(F.col("class").alias("member"), F.col("root").alias("hub"))
        roots = materialize(_roots(classes, links.union(proof(crossing, "crossing_links"))), "roots")
    return roots


def _with_sketches(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    a, b = classes.alias("a"), classes.alias("b")
    return pairs.join(a, F.col("member") == F.col("a.class")).join(b, F.col("hub") == F.col("b.class"))


def _roots(classes: DataFrame, links: DataFrame) -> DataFrame:
    """Root of every class; a class without links is its own."""
    found = connected(links, "member", "hub").select(F.col("node").alias("class"), "root")
    return classes.select("class").join(found, "class", "left").select("class", F.coalesce("root", "class").alias("root"))


def drop_near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, similarity: tuple[int, int] = SIMILARITY,
) -> DataFrame:
    """``docs`` with one document of each component: that of the smallest id. Texts without words all stay.

    Rows that share the kept id, repeated ones among them, stay one row each; so do rows with a null id.
    """
    found = near_duplicates(docs, id_col, text_col, shingle, similarity)
    removed = found.filter(F.col(id_col) != F.col("component_id")).select(F.col(id_col).alias("__removed")).distinct()
    removed = materialize(removed, "removed")
    return docs.join(removed, docs[id_col] == removed["__removed"], "left_anti")
