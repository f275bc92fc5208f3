"""Byte-level BPE without regular expressions: boundaries by a scan of transition functions, then cached merges.

A text becomes an array of code-point classes. A small automaton over the classes tells where a new
slice starts. Its transition functions are composed in blocks: first all blocks at once, one function
per block; then the functions of the blocks are combined by doubling (composition is associative);
then every block runs from its known state. Slices are looked up in a bounded cache; the ones it lacks
are merged together, one merge of each slice at a time.

Null texts count as empty and give no ids. Surrogates in a text are encoded as U+FFFD.
"""

from __future__ import annotations

import base64
import heapq
import sys
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from orderloom.llm.common import chunks, id_text, texts_of

# Classes of code points. ONE and TWO are apostrophes followed by a contraction of one or two letters.
LETTER, NUMBER, OTHER, SPACE, WHITE, ONE, TWO, BREAK = range(8)
# States: what the last code point left open. WANT1 and WANT2 count letters of a contraction still to come.
FRESH, IN_LETTERS, IN_NUMBER, IN_OTHER, AFTER_SPACE, IN_WHITE, WANT1, WANT2 = range(8)
# White space by the Unicode property, besides the plain space.
_WHITE = [9, 10, 11, 12, 13, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
# The endings that follow an apostrophe as a slice of their own.
_ENDINGS_1, _ENDINGS_2 = "stmd", ("re", "ve", "ll")
_BLOCK = 64
#: Code points that are encoded at once: some 150 bytes of temporaries each.
AT_ONCE = 250_000
_SENTINEL = 0x110000
_NONE = np.int32(2**31 - 1)
_SHIFT = np.int64(20)
_MASKS = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


@lru_cache(1)
def _classes() -> np.ndarray:
    """Class of each code point, by its general category."""
    table = np.full(_SENTINEL + 1, OTHER, np.uint8)
    for point in range(_SENTINEL):
        kind = unicodedata.category(chr(point))[0]
        if kind == "L":
            table[point] = LETTER
        elif kind == "N":
            table[point] = NUMBER
    table[_WHITE] = WHITE
    table[32] = SPACE
    table[_SENTINEL] = BREAK
    return table


@lru_cache(1)
def _automaton() -> tuple[np.ndarray, np.ndarray]:
    """Next state and whether a slice starts, by class and state."""
    move, starts = np.zeros((8, 8), np.uint8), np.zeros((8, 8), bool)
    run = {LETTER: IN_LETTERS, NUMBER: IN_NUMBER, OTHER: IN_OTHER, ONE: IN_OTHER, TWO: IN_OTHER}
    for state in range(8):
        for kind in range(8):
            if kind == BREAK:
                move[kind, state], starts[kind, state] = FRESH, True
            elif state in (WANT1, WANT2):
                move[kind, state] = FRESH if state == WANT1 else WANT1
            elif kind in (SPACE, WHITE):
                # A run of white space is one slice; its last code point is cut off afterwards.
                move[kind, state] = AFTER_SPACE if kind == SPACE else IN_WHITE
                starts[kind, state] = state not in (AFTER_SPACE, IN_WHITE)
            elif kind in (ONE, TWO) and state not in (IN_OTHER, AFTER_SPACE):
                move[kind, state], starts[kind, state] = (WANT1 if kind == ONE else WANT2), True
            else:
                move[kind, state] = run[kind]
                starts[kind, state] = state not in (run[kind], AFTER_SPACE)
    return move, starts


def _states_before(kinds: np.ndarray, move: np.ndarray) -> np.ndarray:
    """State before each code point: a blocked scan of composed transition functions."""
    n = len(kinds)
    rows = -(-n // _BLOCK)
    grid = np.full(rows * _BLOCK, BREAK, np.uint8)
    grid[:n] = kinds
    grid = np.ascontiguousarray(grid.reshape(rows, _BLOCK).T)
    flat = move.ravel()
    whole = np.tile(np.arange(8, dtype=np.uint8), (rows, 1))
    for column in grid:
        whole = flat.take((column[:, None] << 3) | whole)
    # Doubling: after each step a row holds the function of up to twice as many blocks before it.
    step = 1
    while step < rows:
        later = np.take_along_axis(whole[step:], whole[:-step], axis=1)
        whole = np.concatenate([whole[:step], later])
        step *= 2
    state = np.empty(rows, np.uint8)
    state[0], state[1:] = FRESH, whole[:-1, FRESH]
    before = np.empty((_BLOCK, rows), np.uint8)
    for i, column in enumerate(grid):
        before[i] = state
        state = flat.take((column << 3) | state)
    return before.T.ravel()[:n]


def boundaries(points: np.ndarray) -> np.ndarray:
    """Positions at which slices start. The sentinel separates texts and is a slice of its own."""
    if not len(points):
        return np.zeros(0, np.int64)
    kinds = _classes()[points]
    quotes = np.flatnonzero(points == 39)
    if len(quotes):
        ahead = np.concatenate([points, [_SENTINEL, _SENTINEL]])
        first, second = ahead[quotes + 1], ahead[quotes + 2]
        kinds[quotes[np.isin(first, [ord(c) for c in _ENDINGS_1])]] = ONE
        two = np.isin(first * _SENTINEL + second.astype(np.int64), [ord(a) * _SENTINEL + ord(b) for a, b in _ENDINGS_2])
        kinds[quotes[two]] = TWO
    move, starts = _automaton()
    opens = starts.ravel().take((kinds << 3) | _states_before(kinds, move))
    # The last white space before other text is a slice of its own, or with a plain space begins the next one.
    white = (kinds == SPACE) | (kinds == WHITE)
    opens[:-1] |= white[:-1] & ~white[1:] & (kinds[1:] != BREAK)
    # After white space other than a plain space, and after a contraction, a new slice starts anyway (automaton).
    return np.flatnonzero(opens)


class Vocabulary:
    """Ranks of a byte-level vocabulary, with a bounded cache of merged slices."""

    #: Slices and bytes of a generation of the cache: once it is full, the one before it is forgotten and slices that
    #: are met again move on. Slices of over LONG bytes are merged one by one.
    CACHE, CACHE_BYTES, LONG = 100_000, 1 << 23, 64

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            pairs = [line.split() for line in lines if line.strip()]
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self.tokens = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            self.tokens[rank] = token
        self.sizes = np.array([len(t) for t in self.tokens], np.int64)
        self.bytes = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        keys, merged = [], []
        for token, rank in self.ranks.items():
            for cut in range(1, len(token)):
                left, right = self.ranks.get(token[:cut]), self.ranks.get(token[cut:])
                if left is not None and right is not None:
                    keys.append(left << int(_SHIFT) | right)
                    merged.append(rank)
        order = np.argsort(keys)
        self.keys, self.merged = np.array(keys, np.int64)[order], np.array(merged, np.int32)[order]
        # A generation of the cache: numbers of slices, and the ids of number n at flat[first[n]:first[n + 1]].
        self.cache: dict[bytes, int] = {}
        self.flat, self.first = np.zeros(0, np.uint32), np.zeros(1, np.int64)
        self._turn()

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = (left.astype(np.int64) << _SHIFT) | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.merged[at], _NONE)

    def merge_many(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of many short slices: in each round, every slice makes its lowest-ranked, leftmost merge."""
        out: list[bytes] = [b""] * len(pieces)
        todo = []
        for i, piece in enumerate(pieces):
            rank = self.ranks.get(piece)
            if rank is not None:
                out[i] = rank.to_bytes(4, "little")
            elif len(piece) > self.LONG:
                out[i] = self.merge_long(piece)
            elif piece:
                todo.append(i)
        if not todo:
            return out
        sizes = np.array([len(pieces[i]) for i in todo])
        ids = self.bytes[np.frombuffer(b"".join(pieces[i] for i in todo), np.uint8)]
        owner = np.repeat(np.arange(len(todo), dtype=np.int32), sizes)
        rank = np.full(len(ids), _NONE, np.int32)
        inner = np.flatnonzero(owner[:-1] == owner[1:])
        rank[inner] = self._rank(ids[inner], ids[inner + 1])
        done_ids, done_owner = [], []
        while len(ids):
            first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            least = np.repeat(np.minimum.reduceat(rank, first), np.diff(np.r_[first, len(ids)]))
            over = least == _NONE
            if over.any():
                done_ids.append(ids[over])
                done_owner.append(owner[over])
                ids, owner, rank, least = ids[~over], owner[~over], rank[~over], least[~over]
                if not len(ids):
                    break
            hit = np.flatnonzero(rank == least)
            hit = hit[np.r_[True, owner[hit[1:]] != owner[hit[:-1]]]]
            ids[hit] = rank[hit]
            stay = np.ones(len(ids), bool)
            stay[hit + 1] = False
            ids, owner, rank = ids[stay], owner[stay], rank[stay]
            hit -= np.arange(len(hit))
            for at in (hit, hit[hit > 0] - 1):
                rank[at] = _NONE
                pair = at[at + 1 < len(ids)]
                pair = pair[owner[pair] == owner[pair + 1]]
                rank[pair] = self._rank(ids[pair], ids[pair + 1])
        ids, owner = np.concatenate(done_ids), np.concatenate(done_owner)
        order = np.argsort(owner, kind="stable")
        ends = np.cumsum(np.bincount(owner, minlength=len(todo))) * 4
        packed = ids[order].astype("<u4").tobytes()
        start = 0
        for i, end in zip(todo, ends.tolist()):
            out[i] = packed[start:end]
            start = end
        return out

    def merge_long(self, piece: bytes) -> bytes:
        """Ids of one long slice, in n log n steps: a heap of merges over a linked list."""
        ids: list = self.bytes[np.frombuffer(piece, np.uint8)].tolist()
        after, before = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        pairs = self._pairs()
        heap = [(pairs[k], i, *k) for i, k in enumerate(zip(ids, ids[1:])) if k in pairs]
        heapq.heapify(heap)
        while heap:
            rank, i, left, right = heapq.heappop(heap)
            j = after[i] if ids[i] is not None else len(ids)
            if j == len(ids) or ids[i] != left or ids[j] != right:
                continue
            ids[i], ids[j] = rank, None
            after[i] = after[j]
            if after[i] < len(ids):
                before[after[i]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b < len(ids) and (key := (ids[a], ids[b])) in pairs:
                    heapq.heappush(heap, (pairs[key], a, *key))
        return np.array([x for x in ids if x is not None], "<u4").tobytes()

    @lru_cache(1)  # noqa: B019
    def _pairs(self) -> dict[tuple[int, int], int]:
        mask = (1 << int(_SHIFT)) - 1
        return {(k >> int(_SHIFT), k & mask): m for k, m in zip(self.keys.tolist(), self.merged.tolist())}

    def _turn(self) -> None:
        """Begin a generation of the cache; the one that was full becomes the older one."""
        self.older = (self.cache, self.flat, self.first)
        self.cache, self.held = {}, 0
        self.flat, self.first = np.zeros(0, np.uint32), np.zeros(1, np.int64)

    def _learn(self, pieces: list[bytes]) -> None:
        """Add slices that the cache lacks: from the older generation, or merged now."""
        numbers, flat, first = self.older
        known = [p for p in pieces if p in numbers]
        fresh = [p for p in pieces if p not in numbers] if known else pieces
        merged = self.merge_many(fresh)
        at = np.array([numbers[p] for p in known], np.int64)
        sizes = np.concatenate([first[at + 1] - first[at], np.array([len(x) // 4 for x in merged], np.int64)])
        upto = np.cumsum(sizes)
        kept = int(upto[len(at) - 1]) if len(at) else 0
        moved = flat[np.arange(kept) + np.repeat(first[at] - (upto - sizes)[: len(at)], sizes[: len(at)])]
        base = len(self.first) - 1
        self.cache.update(zip([*known, *fresh], range(base, base + len(pieces))))
        self.held += sum(map(len, pieces))
        self.flat = np.concatenate([self.flat, moved, np.frombuffer(b"".join(merged), "<u4")])
        self.first = np.concatenate([self.first, self.first[-1] + upto])

    def _numbers(self, raw: bytes, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """A number for each slice of `raw`; `flat[first[n]:first[n + 1]]` are the ids of number n.

        Slices of up to 15 bytes are told apart by the bytes themselves, in two machine words, so
        that only one of each goes through the cache.
        """
        padded = np.frombuffer(raw + bytes(16), np.uint8)
        words = np.ndarray(len(raw) + 8, "<u8", padded, strides=(1,))
        low = np.minimum(sizes, 8).astype(np.uint64) * np.uint64(8)
        high = np.clip(sizes - 8, 0, 7).astype(np.uint64) * np.uint64(8)
        one = words[starts] & _MASKS[low >> np.uint64(3)]
        two = (words[np.minimum(starts + 8, len(raw))] & _MASKS[high >> np.uint64(3)]) | (sizes.astype(np.uint64) << np.uint64(56))
        key = (one ^ (two * np.uint64(0x9E3779B97F4A7C15))) * np.uint64(0xD6E8FEB86659FD93)
        short = np.flatnonzero(sizes < 16)
        order = short[np.argsort(key[short])]
        fresh = np.ones(len(order), bool)
        fresh[1:] = (key[order[1:]] != key[order[:-1]]) | (one[order[1:]] != one[order[:-1]]) | (two[order[1:]] != two[order[:-1]])
        chosen = np.concatenate([order[fresh], np.flatnonzero(sizes >= 16)])
        begin, end = starts[chosen], starts[chosen] + sizes[chosen]
        pieces = [raw[a:b] for a, b in zip(begin.tolist(), end.tolist())]
        if self.cache and (len(self.cache) + len(pieces) > self.CACHE or self.held > self.CACHE_BYTES):
            self._turn()
        get = self.cache.get
        got = list(map(get, pieces))
        lacking = {p for p, n in zip(pieces, got) if n is None}
        if lacking:
            self._learn(list(lacking))
            got = list(map(get, pieces))
        number = np.empty(len(starts), np.int64)
        numbers = np.array(got, np.int64)
        kinds = int(fresh.sum())
        number[order] = numbers[:kinds][np.cumsum(fresh) - 1]
        number[chosen[kinds:]] = numbers[kinds:]
        return number

    def encode(self, texts: list[str]) -> Iterator[tuple[bytes, np.ndarray, np.ndarray]]:
        """Per text: its ids as little-endian 32-bit integers, where its slices start, and the ids in each slice."""
        for start, end in chunks(texts, AT_ONCE):
            joined = "\0".join(texts[start:end]) + "\0"
            points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4").copy()
            points[(points >> 11) == 0x1B] = 0xFFFD
            ends = np.cumsum([len(t) + 1 for t in texts[start:end]]) - 1
            width = 1 + (points > 0x7F).astype(np.int64) + (points > 0x7FF) + (points > 0xFFFF)
            at_byte = np.concatenate([[0], np.cumsum(width)])
            points[ends] = _SENTINEL
            raw = joined.encode("utf-8") if joined.isascii() else joined.encode("utf-16", "surrogatepass").decode("utf-16", "replace").encode("utf-8")
            cuts = boundaries(points)
            bytes_at = at_byte[cuts]
            number = self._numbers(raw, bytes_at, np.diff(at_byte[np.r_[cuts, len(points)]]))
            counts = self.first[number + 1] - self.first[number]
            stops = np.searchsorted(cuts, ends)
            counts[stops] = 0
            until = np.cumsum(counts)
            total = int(until[-1])
            take = np.arange(total) + np.repeat(self.first[number] - (until - counts), counts)
            packed = self.flat[take].tobytes()
            first = done = 0
            for stop, base in zip(stops.tolist(), np.r_[0, ends[:-1] + 1].tolist()):
                upto = 4 * int(until[stop])
                yield packed[done:upto], cuts[first:stop] - base, counts[first:stop]
                first, done = stop + 1, upto

    def decode(self, ids: bytes) -> bytes:
        """The bytes of a run of ids; ids that the vocabulary lacks are an error."""
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))

    def decode_slices(self, ids: bytes, starts: np.ndarray, counts: np.ndarray) -> bytes:
        """The bytes of a run of ids, slice by slice, each of which must span what its start and the next one's say.

        `starts` are code points in the text, `counts` ids of each slice, as `encode` gives them. An offset that does not
        fit the ids is an error.
        """
        numbers, decoded = np.frombuffer(ids, "<u4"), self.decode(ids)
        if int(counts.sum()) != len(numbers):
            raise ValueError("slices do not cover the ids")
        ends = np.r_[0, np.cumsum(self.sizes[numbers])][np.cumsum(counts)]
        # Code points of the decoded bytes: all but continuation bytes begin one.
        begins = (np.frombuffer(decoded, np.uint8) & 0xC0) != 0x80
        upto = np.r_[0, np.cumsum(begins)]
        if (len(starts) and starts[0] != 0) or not np.array_equal(upto[ends[:-1]], starts[1:]) or not begins[ends[:-1]].all():
            raise ValueError("slices do not lie where their offsets say")
        return decoded


@lru_cache(4)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def encode(docs: DataFrame, ranks_path: str, id_col: str = "doc_id", text_col: str = "text", offsets: bool = False) -> DataFrame:
    """Ids of every text: doc_id, n_tokens, ids (binary, little-endian unsigned 32-bit).

    With `offsets` also slice_starts (code points) and slice_tokens (ids in each slice), from which the
    source of an id can be told. `ranks_path` is read by the executors. One row per row; an empty table
    gives an empty result; repeated rows are encoded alike.
    """
    source = id_text(docs, id_col, text_col)
    kind = source.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_tokens bigint, ids binary" + ", slice_starts array<int>, slice_tokens array<int>" * offsets

    def run(batches):
        words = vocabulary(ranks_path)
        for batch in batches:
            texts = texts_of(batch.column("text"))
            names = batch.column("doc_id")
            row = 0
            for start, end in chunks(texts, AT_ONCE):
                got = list(words.encode(texts[start:end]))
                ids = [x[0] for x in got]
                columns = [names.slice(row, len(got)), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())]
                if offsets:
                    columns.append(pa.array([x[1].astype(np.int32) for x in got], pa.list_(pa.int32())))
                    columns.append(pa.array([x[2].astype(np.int32) for x in got], pa.list_(pa.int32())))
                row += len(got)
                yield pa.RecordBatch.from_arrays(columns, [f.split()[0] for f in schema.split(", ")])

    return source.mapInArrow(run, schema)


def round_trip(docs: DataFrame, ranks_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`encode`, and the bytes of the ids that it gave, decoded by its offsets, in one pass: doc_id, n_tokens, ids, decoded.

    The same as applying one after the other, with one Python worker and one copy of the vocabulary per task.
    """
    source = id_text(docs, id_col, text_col)
    kind = source.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "n_tokens", "ids", "decoded"]

    def run(batches):
        words = vocabulary(ranks_path)
        for batch in batches:
            texts, row = texts_of(batch.column("text")), 0
            for start, end in chunks(texts, AT_ONCE):
                found = list(words.encode(texts[start:end]))
                ids = [x for x, _, _ in found]
                back = pa.array([words.decode_slices(*x) for x in found], pa.binary())
                counts = pa.array([len(x) // 4 for x in ids], pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(row, len(ids)), counts, pa.array(ids, pa.binary()), back], names)
                row += len(ids)

    return source.mapInArrow(run, f"doc_id {kind}, n_tokens bigint, ids binary, decoded binary")


def decode(encoded: DataFrame, ranks_path: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """The bytes of each row's ids: doc_id, the columns in `keep`, decoded (binary). Null ids decode to no bytes."""
    source = encoded.select(*dict.fromkeys(["doc_id", *keep, "ids"]))
    names = ["doc_id", *keep, "decoded"]
    schema = ", ".join(f"`{n}` {source.schema[n].dataType.simpleString()}" for n in names[:-1]) + ", decoded binary"

    def run(batches):
        words = vocabulary(ranks_path)
        for batch in batches:
            out = [words.decode(x or b"") for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names[:-1]), pa.array(out, pa.binary())], names)

    return source.mapInArrow(run, schema)


assert sys.byteorder == "little"
