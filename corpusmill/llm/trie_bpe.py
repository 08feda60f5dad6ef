"""BPE encoding and decoding by prefix-sharing trie traversal.

The distinct pieces of about a megabyte of text are put into a trie over their symbols. Going down the trie, each node gets
the last token of the encoding of its prefix: the one vocabulary entry that ends there and may stand beside the last token
of the prefix before it. A prefix that many pieces share is therefore encoded once, and a piece's tokens are read off by
stepping back over last tokens. Two tokens may stand side by side when no merge ever crosses their border; that is read off
the parts of both that touch the border and the ranks at which those parts are merged away.

The trie is walked a level at a time, all nodes of a level at once in numpy. Which vocabulary entries end at a node, longest
first, comes from an automaton of the vocabulary with suffix links. Words and pieces are split, told apart and put together
again in Arrow, so Python touches only words that the quick cut does not know.

Each task works on its own words; nothing is shuffled or collected, and nothing of the texts outlives its slice.

Defined results: null is the empty text; a text without tokens has an empty list, and decodes to the empty text.
"""

from __future__ import annotations

import gc
import json
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from corpusmill.llm.arrays import per_process, task, trim

SLICE_BYTES = 1 << 20
# Pieces of one trie, and places for known pairs of tokens.
CACHE_WORDS = 100_000
CACHE_PAIRS = 1 << 18
CUT_WORDS = 5_000
# Longer pieces are walked one by one: their deep levels have too few nodes for numpy.
LEVELS = 256
NEVER = 1 << 30
# Symbols are code points; the last one of a piece, which carries the mark of a word end, is END higher.
END, WIDE = 1 << 21, 1 << 22

PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
LETTER, DIGIT, OTHER, GAP = 1, 2, 3, 4


def quick_steps(spec: dict) -> bool:
    """Whether the file's steps come to runs of letters, single digits and runs of others, but for apostrophes and blanks."""
    clean = [x["type"] for x in (spec.get("normalizer") or {}).get("normalizers", [])]
    steps = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
    if clean != ["NFC", "Replace", "Lowercase"] or [x["type"] for x in steps] != ["Split", "ByteLevel"]:
        return False
    split, level = steps
    if split["pattern"] != {"Regex": PATTERN} or not (split["invert"] and split["behavior"] == "Removed"):
        return False
    if level["use_regex"] or level["add_prefix_space"]:
        return False
    return all("<|" in t["content"] for t in spec.get("added_tokens", []))


def byte_symbols() -> np.ndarray:
    """The code point that byte-level files write for each byte."""
    shown = np.zeros(256, bool)
    for lo, hi in ((0x21, 0x7E), (0xA1, 0xAC), (0xAE, 0xFF)):
        shown[lo : hi + 1] = True
    return np.where(shown, np.arange(256), 255 + np.cumsum(~shown)).astype(np.int32)


def symbols_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts and the offset of each."""
    at = np.concatenate(([0], np.cumsum([len(t) for t in texts], dtype=np.int64)))
    return np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.int32).copy(), at


def bytes_of(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all words of a binary array and the offset of each."""
    _, offsets, data = words.buffers()
    at = np.frombuffer(offsets, np.int64)[words.offset : words.offset + len(words) + 1] if offsets else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def any_of(flags: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether a flag is set between two neighbouring offsets; also right where nothing lies between."""
    seen = np.concatenate(([0], np.cumsum(flags)))
    return seen[at[1:]] > seen[at[:-1]]


def lists(values, at) -> pa.ListArray:
    at = at if isinstance(at, pa.Array) else pa.array(at, pa.int32())
    return pa.ListArray.from_arrays(at, values)


def put_together(parts: pa.ListArray, index, at: np.ndarray) -> pa.ListArray:
    """Lists made of several ``parts`` each: the list k has those at ``index[at[k]:at[k + 1]]``, one after the other."""
    taken = parts.take(index)
    return pa.ListArray.from_arrays(taken.offsets.take(at), taken.values)


def slices(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Runs of whole texts of about ``SLICE_BYTES``: first and number."""
    at = np.concatenate(([0], np.cumsum(pc.binary_length(texts).to_numpy(), dtype=np.int64)))
    row = 0
    while row < len(texts):
        end = max(row + 1, int(np.searchsorted(at, at[row] + SLICE_BYTES, "right")) - 1)
        yield row, end - row
        row = end


class TrieEncoder:
    """Vocabulary, its automaton and merge ranks as arrays."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        ids: dict[str, int] = model["vocab"]
        # Unicode clean-up and the cut into pieces are the file's own; the encoding is done here.
        library = Tokenizer.from_str(json.dumps(spec | {"model": model | {"vocab": {}, "merges": []}}))
        self.normalize = library.normalizer.normalize_str if library.normalizer else str
        self.cut = library.pre_tokenizer.pre_tokenize_str
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", []) if t.get("special")}
        self.tokens = {i: t for t, i in (*ids.items(), *self.special.items())}
        self.quick = quick_steps(spec)
        self.kinds = np.zeros(0x110000, np.uint8)
        self.symbols = byte_symbols()
        self._learn_words(ids, model.get("end_of_word_suffix") or "")
        self._learn_merges(ids, [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]])
        self.pairs = np.full(CACHE_PAIRS, -1, np.int64)
        self.fitting = np.zeros(CACHE_PAIRS, bool)
        del spec, model, ids
        gc.freeze()
        trim()

    def _learn_words(self, ids: dict[str, int], suffix: str) -> None:
        """The automaton of the vocabulary. States are numbered by depth from the root 0, so that ``keys``, the
        state before and the symbol of every other state, are in order."""
        ended = np.array([bool(suffix) and t.endswith(suffix) for t in ids])
        numbers = np.fromiter(ids.values(), np.int64, len(ids))
        symbols, at = symbols_of([t.removesuffix(suffix) if e else t for t, e in zip(ids, ended)])
        size = np.diff(at)
        symbols[at[1:][ended & (size > 0)] - 1] += END
        state = np.zeros(len(ids), np.int64)
        self.keys = np.zeros(0, np.int64)
        self.fail = self.near = self.depth = np.zeros(1, np.int32)
        self.token = np.full(1, -1, np.int32)
        for level in range(int(size.max())):
            alive = np.flatnonzero(size > level)
            new, back = np.unique(state[alive] * WIDE + symbols[at[alive] + level], return_inverse=True)
            first = len(self.keys) + 1
            state[alive] = first + back
            token = np.full(len(new), -1, np.int32)
            done = size[alive] == level + 1
            token[back[done]] = numbers[alive[done]]
            fail = self._goto(self.fail[new // WIDE], new % WIDE) if level else np.zeros(len(new), np.int32)
            near = np.where(token >= 0, first + np.arange(len(new)), self.near[fail]).astype(np.int32)
            self.keys = np.concatenate([self.keys, new])
            self.fail = np.concatenate([self.fail, fail])
            self.near = np.concatenate([self.near, near])
            self.token = np.concatenate([self.token, token])
            self.depth = np.concatenate([self.depth, np.full(len(new), level + 1, np.int32)])

    def _goto(self, state: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        """The longest suffix of what was read, with one symbol more, that some vocabulary entry begins with."""
        out = np.zeros(len(state), np.int32)
        todo = np.arange(len(state))
        while len(todo):
            key = state * np.int64(WIDE) + symbol
            place = np.searchsorted(self.keys, key)
            hit = self.keys[np.minimum(place, len(self.keys) - 1)] == key
            out[todo[hit]] = place[hit] + 1
            rest = np.flatnonzero(~hit & (state > 0))
            todo, state, symbol = todo[rest], self.fail[state[rest]], symbol[rest]
        return out

    def _learn_merges(self, ids: dict[str, int], merges: list[tuple[str, str]]) -> None:
        """Ranks of merges, and the parts of every token that touch its left or right edge."""
        self.n = n = max(ids.values()) + 1
        rank = {ids[a] * n + ids[b]: i for i, (a, b) in enumerate(merges)}
        keys = np.fromiter(rank, np.int64, len(rank))
        order = np.argsort(keys)
        self.merges, self.ranks = keys[order], np.fromiter(rank.values(), np.int64, len(rank))[order]
        child, ends = np.full((2, n), -1, np.int64), np.full(n, NEVER, np.int64)
        for i, (a, b) in enumerate(merges):
            made = ids.get(a + b)
            if made is not None:
                child[:, made], ends[made] = (ids[a], ids[b]), i
        self.left, self.right = self._spines(child[1], ends), self._spines(child[0], ends)

    def _spines(self, child: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each token where its parts begin; all parts, shortest first; the rank that ends each."""
        own = part = np.arange(self.n)
        end = np.full(self.n, NEVER)
        found = [(own, part, end)]
        while len(own):
            inner = np.flatnonzero(child[part] >= 0)
            own, part, end = own[inner], child[part[inner]], rank[part[inner]]
            found.append((own, part, end))
        size = np.concatenate([np.full(len(x[0]), -i) for i, x in enumerate(found)])
        own, part, end = (np.concatenate(x) for x in zip(*found))
        order = np.lexsort((size, own))
        begin = np.concatenate(([0], np.cumsum(np.bincount(own, minlength=self.n))[:-1]))
        return begin, part[order].astype(np.int32), end[order].astype(np.int32)

    def _fits(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether merging the symbols of both gives the two again, that is, no merge ever crosses their border."""
        key = left * np.int64(self.n) + right
        slot = (key * np.int64(0x9E3779B1) >> 7) % len(self.pairs)
        fits = self.fitting[slot]
        asked = np.flatnonzero(self.pairs[slot] != key)
        if len(asked):
            new, back = np.unique(key[asked], return_inverse=True)
            answer = self._beside(new // self.n, new % self.n)
            fits[asked] = answer[back]
            # Of several pairs for one place the last stays, so write both from one choice.
            slot = (new * np.int64(0x9E3779B1) >> 7) % len(self.pairs)
            slot, chosen = np.unique(slot, return_index=True)
            self.pairs[slot], self.fitting[slot] = new[chosen], answer[chosen]
        return fits

    def _beside(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        (a_begin, a_part, a_end), (b_begin, b_part, b_end) = self.left, self.right
        a, b = a_begin[left], b_begin[right]
        out = np.zeros(len(left), bool)
        todo = np.arange(len(left))
        while len(todo):
            key = a_part[a] * np.int64(self.n) + b_part[b]
            place = np.minimum(np.searchsorted(self.merges, key), len(self.merges) - 1)
            rank = np.where(self.merges[place] == key, self.ranks[place], NEVER)
            x_end, y_end = a_end[a], b_end[b]
            # Of equal ranks the leftmost pair is merged first.
            crossed = (rank < x_end) & (rank <= y_end)
            whole = ~crossed & (x_end == NEVER) & (y_end == NEVER)
            out[todo[whole]] = True
            rest = np.flatnonzero(~crossed & ~whole)
            step = x_end[rest] <= y_end[rest]
            todo, a, b = todo[rest], a[rest] + step, b[rest] + ~step
        return out

    def _last(self, state: np.ndarray, end: int, base: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Last token of the encoding of prefixes of ``end`` symbols, and where it begins."""
        token, start = np.zeros(len(state), np.int32), np.zeros(len(state), np.int32)
        todo, near = np.arange(len(state)), self.near[state]
        while len(todo):
            if not near.all():
                raise ValueError("no token ends with a symbol of a text")
            found, begin = self.token[near], end - self.depth[near]
            fits = begin == 0
            inner = np.flatnonzero(~fits)
            fits[inner] = self._fits(last[base[todo[inner]] + begin[inner] - 1], found[inner])
            token[todo[fits]], start[todo[fits]] = found[fits], begin[fits]
            rest = np.flatnonzero(~fits)
            todo, near = todo[rest], self.near[self.fail[near[rest]]]
        return token, start

    def _walk_levels(self, symbols: np.ndarray, at: np.ndarray, last: np.ndarray, begin: np.ndarray) -> None:
        """Last token, and where it begins, of every prefix of pieces in order: those that share one stand side by side."""
        size = np.diff(at)
        state = np.zeros(len(size), np.int32)
        node = np.zeros(len(size), np.int32)
        alive = np.arange(len(size))
        for level in range(int(size.max(initial=0))):
            alive = alive[size[alive] > level]
            place = at[alive] + level
            symbol, above = symbols[place], node[alive]
            new = np.ones(len(alive), bool)
            new[1:] = (above[1:] != above[:-1]) | (symbol[1:] != symbol[:-1])
            head = np.flatnonzero(new)
            one = alive[head]
            reached = self._goto(state[one], symbol[head])
            token, start = self._last(reached, level + 1, at[one], last)
            below = np.cumsum(new) - 1
            last[place], begin[place] = token[below], start[below]
            state[alive], node[alive] = reached[below], below

    def _walk_long(self, symbols: np.ndarray, at: np.ndarray, last: np.ndarray, begin: np.ndarray) -> None:
        """The same, one piece after the other."""
        steps: dict[tuple[int, int], int] = {}
        fits: dict[tuple[int, int], bool] = {}
        token_of, near_of, depth_of, fail_of = (x.item for x in (self.token, self.near, self.depth, self.fail))
        for lo, hi in zip(at[:-1].tolist(), at[1:].tolist()):
            state = 0
            path: list[int] = []
            for size, symbol in enumerate(symbols[lo:hi].tolist(), 1):
                if (key := (state, symbol)) not in steps:
                    if len(steps) >= CACHE_PAIRS:
                        steps.clear()
                    steps[key] = self._step(state, symbol)
                state = steps[key]
                near = near_of(state)
                while True:
                    if not near:
                        raise ValueError("no token ends with a symbol of a text")
                    token, start = token_of(near), size - depth_of(near)
                    if not start:
                        break
                    if (key := (path[start - 1], token)) not in fits:
                        if len(fits) >= CACHE_PAIRS:
                            fits.clear()
                        fits[key] = self._stands_beside(*key)
                    if fits[key]:
                        break
                    near = near_of(fail_of(near))
                path.append(token)
                begin[lo + size - 1] = start
            last[lo:hi] = path

    def _step(self, state: int, symbol: int) -> int:
        """``_goto`` of one state."""
        while True:
            key = state * WIDE + symbol
            place = int(self.keys.searchsorted(key))
            if place < len(self.keys) and self.keys.item(place) == key:
                return place + 1
            if not state:
                return 0
            state = self.fail.item(state)

    def _stands_beside(self, left: int, right: int) -> bool:
        """``_beside`` of one pair."""
        (a_begin, a_part, a_end), (b_begin, b_part, b_end) = self.left, self.right
        a, b = a_begin.item(left), b_begin.item(right)
        while True:
            key = a_part.item(a) * self.n + b_part.item(b)
            place = min(int(self.merges.searchsorted(key)), len(self.merges) - 1)
            rank = self.ranks.item(place) if self.merges.item(place) == key else NEVER
            x_end, y_end = a_end.item(a), b_end.item(b)
            if rank < x_end and rank <= y_end:
                return False
            if x_end == y_end == NEVER:
                return True
            if x_end <= y_end:
                a += 1
            else:
                b += 1

    def _encode_sorted(self, symbols: np.ndarray, at: np.ndarray) -> pa.ListArray:
        """Tokens of every piece. In sorted order the pieces are the leaves of their trie."""
        size = np.diff(at)
        symbols[at[1:] - 1] += END
        last, begin = np.zeros(len(symbols), np.int32), np.zeros(len(symbols), np.int32)
        long = size > LEVELS
        for lo in range(0, len(size), CACHE_WORDS):
            for chosen, walk in ((~long, self._walk_levels), (long, self._walk_long)):
                some = lo + np.flatnonzero(chosen[lo : lo + CACHE_WORDS])
                if len(some) == min(CACHE_WORDS, len(size) - lo):
                    a, b = at[some[0]], at[some[-1] + 1]
                    walk(symbols[a:b], at[some[0] : some[-1] + 2] - a, last[a:b], begin[a:b])
                elif len(some):
                    ends = np.concatenate(([0], np.cumsum(size[some])))
                    place = np.arange(ends[-1]) + np.repeat(at[some] - ends[:-1], size[some])
                    found = np.zeros(len(place), np.int32), np.zeros(len(place), np.int32)
                    walk(symbols[place], ends, *found)
                    last[place], begin[place] = found
        # Step back over last tokens: the places where a token ends.
        marked = np.zeros(len(symbols) + 1, bool)
        place, base = at[1:] - 1, at[:-1]
        while len(place):
            marked[place + 1] = True
            rest = np.flatnonzero(begin[place] > 0)
            place, base = base[rest] + begin[place[rest]] - 1, base[rest]
        return lists(last[marked[1:]], np.cumsum(marked)[at])

    def encode_pieces(self, pieces: set[str]) -> dict[str, list[int]]:
        """Token ids of every piece."""
        order = sorted(pieces)
        return dict(zip(order, self._encode_sorted(*symbols_of(order)).to_pylist()))

    def _kinds(self, points: np.ndarray) -> np.ndarray:
        """Whether characters are letters, digits or others, as the file's own cut has it."""
        kinds = self.kinds[points]
        if not kinds.all():
            for point in np.unique(points[kinds == 0]).tolist():
                c = chr(point)
                alone = lambda x: [at for _, at in self.cut(x + c)] == [(0, len(x) + 1)]  # noqa: B023, E731
                self.kinds[point] = LETTER if alone("a") else OTHER if alone("!") else DIGIT if alone("") else GAP
            kinds = self.kinds[points]
        return kinds

    def _quick_words(self, words: pa.Array) -> tuple[list[tuple[np.ndarray, np.ndarray, np.ndarray]], np.ndarray]:
        """Cleaned words of which no step of the file needs to be asked: (which words, their bytes, offsets), and the numbers of the others."""
        raw, at = bytes_of(words)
        wide = raw >= 0x80
        odd = (raw < 0x21) | (raw == 0x7F) | (raw == 0x27)
        odd[:-1] |= (raw[:-1] == 0x3C) & (raw[1:] == 0x7C)
        odd, wide = any_of(odd, at), any_of(wide, at)
        ascii = np.flatnonzero(~odd & ~wide)
        some, ends = bytes_of(words.take(ascii))
        groups = [(ascii, some + ((some >= 0x41) & (some <= 0x5A)).astype(np.uint8) * np.uint8(32), ends)]
        other = [np.flatnonzero(odd)]
        rest = np.flatnonzero(wide & ~odd)
        for lo in range(0, len(rest), CUT_WORDS):
            which = rest[lo : lo + CUT_WORDS]
            shown = [x.decode() for x in words.take(which).to_pylist()]
            keep = np.array([x.isprintable() for x in shown])
            text = self.normalize(" ".join(x for x, good in zip(shown, keep) if good))
            if not text.isprintable() or "'" in text or text.count(" ") != keep.sum() - 1:
                keep[:] = False
            other.append(which[~keep])
            if not keep.any():
                continue
            which = which[keep]
            raw = np.frombuffer(text.encode(), np.uint8)
            gap = raw == 0x20
            ends = np.append(np.flatnonzero(gap), len(raw))
            groups.append((which, raw[~gap], np.concatenate(([0], ends - np.arange(len(ends))))))
        return groups, np.concatenate(other)

    def _runs(self, raw: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Where the pieces of cleaned words begin."""
        first = np.zeros(len(raw) + 1, bool)
        first[at] = True
        if (raw < 0x80).all():
            kinds = self._kinds(raw)
            new = first[:-1] | (kinds == DIGIT)
            new[1:] |= kinds[1:] != kinds[:-1]
            return np.flatnonzero(new)
        head = np.flatnonzero((raw & 0xC0) != 0x80)
        kinds = self._kinds(np.frombuffer(raw.tobytes().decode().encode("utf-32-le"), np.int32))
        new = first[head] | (kinds == DIGIT)
        new[1:] |= kinds[1:] != kinds[:-1]
        return head[new]

    def encode_words(self, words: pa.Array) -> pa.ListArray:
        """Token ids of distinct words."""
        groups, rest = self._quick_words(words) if self.quick else ([], np.arange(len(words)))
        raw = np.concatenate([x[1] for x in groups] or [np.zeros(0, np.uint8)])
        starts, sizes, base = [], [], 0
        for _, part, at in groups:
            new = self._runs(part, at)
            starts.append(new + base)
            sizes.append(np.diff(np.searchsorted(new, at)))
            base += len(part)
        at = np.append(np.concatenate(starts or [np.zeros(0, np.int64)]), len(raw))
        cut = pa.Array.from_buffers(pa.large_binary(), len(at) - 1, [None, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(raw)])
        cut = cut.dictionary_encode()
        order = pc.array_sort_indices(cut.dictionary)
        known, at = bytes_of(cut.dictionary.take(order))
        quick = self._encode_sorted(self.symbols[known], at)
        place = np.empty(len(order), np.int64)
        place[order.to_numpy()] = np.arange(len(order))
        units = [place[cut.indices.to_numpy()]]
        # The file's own cut for all others; special tokens come as ids.
        asked = words.take(rest).to_pylist()
        parts = self._cut(asked)
        pieces = self.encode_pieces({p for x in parts.values() for p in x if isinstance(p, str)})
        number = {p: len(quick) + i for i, p in enumerate(pieces)} | {i: len(quick) + len(pieces) + k for k, i in enumerate(self.special.values())}
        slow = pa.array([*pieces.values(), *([i] for i in self.special.values())], pa.list_(pa.int32()))
        units.append(np.array([number[p] for x in asked for p in parts[x]], np.int64))
        sizes.append(np.array([len(parts[x]) for x in asked], np.int64))
        ends = np.concatenate(([0], np.cumsum(np.concatenate(sizes))))
        found = put_together(pa.concat_arrays([quick, slow]), np.concatenate(units), ends)
        back = np.empty(len(words), np.int64)
        back[np.concatenate([*(x[0] for x in groups), rest])] = np.arange(len(words))
        return found.take(back)

    def _cut(self, words: list[bytes]) -> dict[bytes, list]:
        """Pieces of every word as strings, special tokens as ids. Plain words are cut many at a time."""
        out: dict[bytes, list] = {}
        plain = []
        for word in words:
            text = word.decode()
            if any(x in text for x in self.special) or not text.isprintable():
                out[word] = self._parts(text)
            else:
                plain.append((word, text))
        for lo in range(0, len(plain), CUT_WORDS):
            part = plain[lo : lo + CUT_WORDS]
            text = self.normalize(" ".join(t for _, t in part))
            cells = text.split(" ")
            if len(cells) != len(part):
                out.update((w, self._parts(t)) for w, t in part)
                continue
            ends = np.cumsum([len(c) + 1 for c in cells]).tolist()
            k, pieces = 0, []
            for piece, (start, _) in self.cut(text):
                while start >= ends[k]:
                    out[part[k][0]] = pieces
                    k, pieces = k + 1, []
                pieces.append(piece)
            for word, _ in part[k:]:
                out[word] = pieces
                pieces = []
        return out

    def _parts(self, word: str) -> list:
        """Pieces of one word."""
        for content, number in self.special.items():
            if content in word:
                out: list = []
                for i, rest in enumerate(word.split(content)):
                    out += [number] * (i > 0) + (self._parts(rest) if rest else [])
                return out
        return [piece for piece, _ in self.cut(self.normalize(word))]

    def encode_array(self, texts: pa.Array) -> pa.ListArray:
        """Token ids of every text of a binary array without nulls."""
        words = pc.ascii_split_whitespace(texts.cast(pa.large_string(), safe=False))
        found = words.values.dictionary_encode()
        return put_together(self.encode_words(found.dictionary.cast(pa.large_binary())), found.indices, words.offsets)

    def encode(self, texts: list[bytes | None]) -> list[list[int]]:
        return self.encode_array(pa.array([x or b"" for x in texts], pa.large_binary())).to_pylist()

    def names(self) -> tuple[pa.Array, pa.Array]:
        """Every id as a decimal number, and the token that it stands for."""
        ids = range(max(self.tokens) + 1)
        return pa.array(map(str, ids), pa.large_string()), pa.array(map(self.tokens.get, ids), pa.large_string())

    def decode(self, ids) -> str:
        """Tokens joined by spaces, as a file without a decoder asks for."""
        return " ".join(map(self.tokens.__getitem__, ids))


@contextmanager
def uncollected():
    """No cycle searches: they would walk hundreds of thousands of kept words again and again, and encoding makes no cycles."""
    on = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if on:
            gc.enable()


def texts_of(batch: pa.RecordBatch, name: str) -> pa.Array:
    texts = batch.column(batch.schema.get_field_index(name)).cast(pa.large_binary())
    return texts.fill_null(b"") if texts.null_count else texts


def joined(ids: pa.ListArray, names: pa.Array) -> pa.Array:
    """The names of every list's ids, joined by one space."""
    return pc.binary_join(lists(names.take(ids.values), ids.offsets), pa.scalar(" ", names.type))


def encoder(path: str) -> TrieEncoder:
    return per_process("bpe", ("trie encoder", path), lambda: TrieEncoder(path))


def encode_texts(docs: DataFrame, vocabulary: str, text_col: str = "text", ids_col: str = "ids", with_text: bool = False) -> DataFrame:
    """Every row of ``docs`` with the token ids of its text in place of the text (beside it if ``with_text``)."""
    kept = [f for f in docs.schema.fields if f.name != ids_col and (with_text or f.name != text_col)]
    schema = T.StructType([*kept, T.StructField(ids_col, T.ArrayType(T.IntegerType()))])

    @task("bpe")
    def run(batches):
        coder = encoder(vocabulary)
        for batch in batches:
            texts = texts_of(batch, text_col)
            # About a megabyte at a time: ids take several times the bytes of a text.
            for lo, n in slices(texts):
                with uncollected():
                    ids = coder.encode_array(texts.slice(lo, n))
                part = batch.slice(lo, n)
                columns = [part.column(part.schema.get_field_index(f.name)) for f in kept]
                yield pa.RecordBatch.from_arrays([*columns, ids], [*(f.name for f in kept), ids_col])

    return docs.mapInArrow(run, schema)


def decode_ids(encoded: DataFrame, vocabulary: str, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """Every row with the text that its ids stand for; a null list gives the empty text."""
    kept = [f for f in encoded.schema.fields if f.name != text_col]
    schema = T.StructType([*kept, T.StructField(text_col, T.StringType())])

    @task("bpe")
    def run(batches):
        coder = encoder(vocabulary)
        for batch in batches:
            ids = batch.column(batch.schema.get_field_index(ids_col))
            texts = [coder.decode(x.as_py() or ()) for x in ids]
            columns = [batch.column(batch.schema.get_field_index(f.name)) for f in kept]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(texts, pa.string())], [*(f.name for f in kept), text_col])

    return encoded.mapInArrow(run, schema)


def token_digests(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id``, number of tokens, and SHA-256 of the ids and of the decoded text, without shipping the ids themselves."""
    schema = T.StructType([
        docs.schema[id_col], T.StructField("n_tokens", T.LongType()),
        T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType()),
    ])

    @task("bpe")
    def run(batches):
        from hashlib import sha256

        coder = encoder(vocabulary)
        numbers, names = per_process("bpe", ("names", vocabulary), coder.names)
        for batch in batches:
            texts = texts_of(batch, text_col)
            for lo, n in slices(texts):
                with uncollected():
                    ids = coder.encode_array(texts.slice(lo, n))
                # One column of joined texts at a time: both are larger than the texts.
                codes, decoded = (
                    pa.array([sha256(x.as_buffer()).hexdigest() for x in joined(ids, shown)], pa.string()) for shown in (numbers, names)
                )
                part = batch.slice(lo, n)
                yield pa.RecordBatch.from_arrays(
                    [part.column(part.schema.get_field_index(id_col)), pc.list_value_length(ids).cast(pa.int64()), codes, decoded],
                    [id_col, "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    return docs.select(id_col, text_col).mapInArrow(run, schema)
