"""Phrases whose words stand together more often than apart, by language, counted in HAT-tries.

A task numbers the words it meets and counts phrases in a trie of word numbers: hash containers under a trie that
stays shallow, since only a container that outgrows BURST is split, by the next digit of the phrases' words. When a
task holds too many phrases, it spills its largest subtrees whole, as a run sorted by words; at its end it hands on the rest in the
same way. Runs are dealt by prefix (language, all words but the last, and a share of the last word, so that
the followers of a very frequent prefix do not meet in one task) and merged there by adding up equal phrases.

Lengths are counted one after the other, shortest first. A phrase can only reach the least count if both of
its shorter parts do, so that from two words on a phrase is counted only if a filter of fixed size knows both.
The filter has no false negatives: every phrase that reaches the least count is counted in full.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orderloom.llm.common import Staged, ship
from orderloom.llm.shingles import mix

#: Phrases a task holds before it spills, entries of a container before it bursts, trie levels above containers.
HELD, BURST, LEVELS = 1_000_000, 50_000, 2
#: Bytes of text handled at once, and different words a task numbers before it starts again.
BLOCK, WORDS = 1 << 21, 300_000
#: Bits of the filter for frequent shorter phrases (8 MB, whatever the input); shares of a prefix.
BITS, SHARES = 1 << 26, 256
#: Bits of a word number in a packed phrase, so that three of them fit a 64-bit number.
_WIDE = 21
#: Bits of a word number on which the trie branches.
_DIGIT = 6

# Fixed values of the contract: characters that end a piece.
_ENDS = b".,;:!?\x0a\x0b\x0c\x0d"
_FOLD = bytearray(range(256))
_FOLD[65:91] = bytes(range(97, 123))
_FOLD[9] = 32
for _end in _ENDS:
    _FOLD[_end] = 10
_FOLD = bytes(_FOLD)


class Box:
    """A hash container: open addressing over arrays, so that many phrases are looked up and added at once."""

    def __init__(self, room: int = 256):
        self.keys = np.full(room, -1, np.int64)
        self.counts = np.zeros(room, np.int64)
        self.size = 0

    def add(self, phrases: np.ndarray, counts: np.ndarray) -> None:
        """Add counts of different phrases."""
        if 2 * (self.size + len(phrases)) > len(self.keys):
            self._grow(self.size + len(phrases))
        mask = len(self.keys) - 1
        at = (mix(phrases.view(np.uint64)) & np.uint64(mask)).astype(np.int64)
        while len(phrases):
            free = self.keys[at] == -1
            self.keys[at[free]] = phrases[free]  # of those that want one place, one gets it
            mine = self.keys[at] == phrases
            self.size += int(np.count_nonzero(mine & free))
            self.counts[at[mine]] += counts[mine]
            phrases, counts, at = phrases[~mine], counts[~mine], (at[~mine] + 1) & mask

    def _grow(self, entries: int) -> None:
        phrases, counts = self.entries()
        self.__init__(1 << (4 * entries).bit_length())
        self.add(phrases, counts)

    def entries(self) -> tuple[np.ndarray, np.ndarray]:
        used = np.flatnonzero(self.keys != -1)
        return self.keys[used], self.counts[used]


class Node:
    """A branching of the trie: the subtrees of the phrases that agree in some digits of their word numbers."""

    def __init__(self):
        self.children: dict[int, Box | Node] = {}


class HatTrie:
    """Counts of phrases of `width` word numbers, each packed into one number, first word highest.

    The trie branches on digits of the word numbers, beginning with the first word's: a subtree holds all phrases
    whose first words agree in these digits.
    """

    def __init__(self, width: int, burst: int = BURST, levels: int = LEVELS):
        self.burst, self.levels = burst, levels
        self.shift = _WIDE * (width - 1)
        self.root: Box | Node = Box()
        self.size = 0

    def add(self, phrases: np.ndarray, counts: np.ndarray) -> None:
        """Add counts of different phrases."""
        self.root = self._add(self.root, phrases, counts, 0)

    def _add(self, tree: Box | Node, phrases: np.ndarray, counts: np.ndarray, level: int) -> Box | Node:
        if isinstance(tree, Box):
            before = tree.size
            tree.add(phrases, counts)
            self.size += tree.size - before
            return self._burst(tree, level) if tree.size > self.burst and level < self.levels else tree
        for digit, part in self._by_digit(phrases, level):
            tree.children[digit] = self._add(tree.children.get(digit) or Box(), phrases[part], counts[part], level + 1)
        return tree

    def _by_digit(self, phrases: np.ndarray, level: int) -> Iterator[tuple[int, np.ndarray]]:
        """The digits at this level, and which phrases have each."""
        digit = (phrases >> (self.shift + _DIGIT * level) & (1 << _DIGIT) - 1).astype(np.uint8)
        order = np.argsort(digit, kind="stable")
        ends = np.cumsum(np.bincount(digit, minlength=1 << _DIGIT))
        for value, (a, b) in enumerate(zip([0, *ends[:-1].tolist()], ends.tolist())):
            if a < b:
                yield value, order[a:b]

    def _burst(self, box: Box, level: int) -> Node:
        phrases, counts = box.entries()
        node = Node()
        for digit, part in self._by_digit(phrases, level):
            node.children[digit] = Box(1 << (4 * len(part)).bit_length())
            node.children[digit].add(phrases[part], counts[part])
        return node

    def take(self, most: int) -> tuple[np.ndarray, np.ndarray]:
        """Remove the largest subtrees under the root, whole, until at most `most` phrases are left; all phrases in them."""
        if isinstance(self.root, Box) or not most:
            gone, self.root = [self.root], Box()
        else:
            sizes = {digit: _size(child) for digit, child in self.root.children.items()}
            gone, left = [], self.size
            for digit in sorted(sizes, key=sizes.get, reverse=True):
                if left <= most:
                    break
                left -= sizes[digit]
                gone.append(self.root.children.pop(digit))
        boxes = [box.entries() for tree in gone for box in _boxes(tree)]
        phrases, counts = (np.concatenate([np.zeros(0, np.int64), *parts]) for parts in (zip(*boxes) if boxes else ([], [])))
        self.size -= len(phrases)
        return phrases, counts


def _boxes(tree: Box | Node) -> Iterator[Box]:
    if isinstance(tree, Box):
        yield tree
    else:
        for child in tree.children.values():
            yield from _boxes(child)


def _size(tree: Box | Node) -> int:
    return sum(box.size for box in _boxes(tree))


class _Numbers(dict):
    """Numbers of words in order of their first appearance. 0 is no word, 1 the end of a piece."""

    def __init__(self):
        self.hashes = array("Q", [0, 0])
        self.update({b"": 0, b"\n": 1})

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        self.hashes.append(xxhash.xxh64_intdigest(word))
        return number


def _blocks(raw: bytes, width: int) -> Iterator[list[bytes]]:
    """Words of a folded text in blocks; each begins with the width - 1 words before it, so that no phrase is cut."""
    at, carried = 0, []
    while at < len(raw):
        end = len(raw) if len(raw) - at <= BLOCK else raw.find(b" ", at + BLOCK)
        if end < 0:
            end = len(raw)
        words = [*carried, *raw[at:end].replace(b"\n", b" \n ").split(b" ")]
        yield words
        at, carried = end, []
        for word in reversed(words):
            if len(carried) == width - 1:
                break
            if word:
                carried.insert(0, word)


def _phrase_hash(words: list[np.ndarray], lang: int | np.ndarray) -> np.ndarray:
    """Hash of phrases from the hashes of their words and of the language, one for all or one each."""
    value = np.full(len(words[0]), lang, np.uint64)
    for word in words:
        value = mix(value * np.uint64(0x9E3779B97F4A7C15) + word)
    return value


def _places(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The two bits of each phrase in the filter."""
    return (hashes & np.uint64(BITS - 1)).astype(np.int64), (hashes >> np.uint64(32) & np.uint64(BITS - 1)).astype(np.int64)


def _known(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    first, second = _places(hashes)
    return (bits[first >> 3] >> (first & 7).astype(np.uint8) & bits[second >> 3] >> (second & 7).astype(np.uint8) & 1).astype(bool)


def _lang_hash(lang: str) -> int:
    return xxhash.xxh64_intdigest(lang.encode("utf-8", "surrogatepass"))


def _filter(spark: SparkSession, frequent: DataFrame, width: int):
    """A broadcast filter over the phrases in `frequent` (lang, phrase): 8 MB at most, from at most 2,048 rows of 4 KB."""

    def run(batches):
        for batch in batches:
            split = [p.split(b" ") for p in batch.column("phrase").cast(pa.binary()).to_pylist()]
            words = [np.array([xxhash.xxh64_intdigest(w[i]) for w in split], np.uint64) for i in range(width)]
            langs = np.array([_lang_hash(x) for x in batch.column("lang").to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(_places(_phrase_hash(words, langs))))], ["p"])

    places = frequent.select("lang", "phrase").mapInArrow(run, "p long")
    rows = places.groupBy(F.expr("p div 32768").alias("bucket")).agg(F.expr("bitmap_construct_agg(p % 32768)").alias("bits")).collect()
    bits = np.zeros((BITS // 32768, 4096), np.uint8)
    for row in rows:
        bits[row["bucket"]] = np.frombuffer(row["bits"], np.uint8)
    return spark.sparkContext.broadcast(bits.ravel())


def _runs(rows: DataFrame, width: int, known, held: int, words: int) -> DataFrame:
    """Sorted runs of the phrases of `rows` (lang, text): prefix, lang, phrase, n. `known` filters the parts of a phrase."""
    names = ["prefix", "lang", "phrase", "n"]

    def run(batches):
        numbers, tries = _Numbers(), {}
        waiting: dict[str, list[bytes]] = {}
        size = 0

        def spill(most: int):
            vocabulary = list(numbers)
            rank = np.zeros(len(vocabulary), np.int64)
            rank[sorted(range(len(vocabulary)), key=vocabulary.__getitem__)] = np.arange(len(vocabulary))
            table, hashes = pa.array(vocabulary, pa.binary()), np.array(numbers.hashes, np.uint64)
            share = most // max(1, len(tries))
            for lang, trie in tries.items():
                phrases, counts = trie.take(share)
                parts = [phrases >> (_WIDE * (width - i - 1)) & (1 << _WIDE) - 1 for i in range(width)]
                # All words but the last, and a share of the last one.
                prefix = _phrase_hash([*(hashes[p] for p in parts[:-1]), hashes[parts[-1]] % np.uint64(SHARES)], _lang_hash(lang))
                order = np.lexsort([rank[p] for p in reversed(parts)])
                for a in range(0, len(order), 50_000):
                    at = order[a : a + 50_000]
                    words = [table.take(pa.array(p[at])) for p in parts]
                    phrase = pc.binary_join_element_wise(*words, b" ") if width > 1 else words[0]
                    columns = [pa.array(prefix[at].view(np.int64)), pa.repeat(pa.scalar(lang, pa.string()), len(at)), phrase.cast(pa.string()), pa.array(counts[at])]
                    yield pa.RecordBatch.from_arrays(columns, names)

        def count(lang: str, text: bytes):
            nonlocal numbers, tries
            own = _lang_hash(lang)
            for block in _blocks(text, width):
                if len(numbers) > words:  # a bounded vocabulary: hand on everything and number anew
                    yield from spill(0)
                    numbers, tries = _Numbers(), {}
                at = np.fromiter(map(numbers.__getitem__, block), np.int64, len(block))
                at = at[at != 0]
                hashes = np.array(numbers.hashes, np.uint64)[at]
                m = len(at) - width + 1
                if m <= 0:
                    continue
                fits = np.logical_and.reduce([at[i : i + m] != 1 for i in range(width)])
                if known is not None:
                    part = _known(known.value, _phrase_hash([hashes[i : len(at) - width + 2 + i] for i in range(width - 1)], own))
                    fits &= part[:m] & part[1 : m + 1]
                packed = np.zeros(m, np.int64)
                for i in range(width):
                    packed = packed << _WIDE | at[i : i + m]
                phrases, counts = np.unique(packed[fits], return_counts=True)
                if not len(phrases):
                    continue
                if lang not in tries:
                    tries[lang] = HatTrie(width)
                tries[lang].add(phrases, counts)
                if sum(t.size for t in tries.values()) > held:
                    yield from spill(held // 4)

        def drain():
            for lang, texts in waiting.items():
                yield from count(lang, b"\n".join(texts))
            waiting.clear()

        for batch in batches:
            # One text after the other: a batch of long texts is not copied as a whole.
            for lang, text in zip(batch.column("lang"), batch.column("text").cast(pa.binary())):
                lang, raw = lang.as_py(), text.as_py().translate(_FOLD)
                waiting.setdefault(lang, []).append(raw)
                size += len(raw)
                if size >= BLOCK:
                    yield from drain()
                    size = 0
        yield from drain()
        yield from spill(0)

    return rows.mapInArrow(run, "prefix long, lang string, phrase string, n long")


def phrase_counts(rows: DataFrame, width: int, known=None, held: int = HELD, words: int = WORDS) -> DataFrame:
    """lang, phrase, n: every phrase of `width` words, of which `known` knows both shorter parts, with its count.

    A phrase has one prefix, so that the runs dealt by prefix are merged where they arrive.
    """
    runs = _runs(rows, width, known, held, words).repartition("prefix")
    return runs.groupBy("prefix", "lang", "phrase").agg(F.sum("n").alias("n")).drop("prefix")


def collocations(
    spark: SparkSession, docs: DataFrame, longest: int = 3, least: int = 10, percent: int = 50, top: int | None = 2000, text_col: str = "text", lang_col: str = "lang", held: int = HELD, words: int = WORDS
) -> DataFrame:
    """The strongest phrases of 2 to `longest` (3 at most) words: lang, rank, phrase, a, l, r, n, score.

    Texts are lower-cased (A to Z) and cut into pieces at `.,;:!?` and line ends, pieces into words at blanks and tabs.
    a: occurrences of the phrase, at least `least`; n: words of the language; l, r: occurrences of the two parts at
    the cut with the lowest score, floor(1000000 a a / (l r)), the first such cut. A phrase inside a longer one that
    has `percent` of its occurrences or more is left out. Ties in rank: more occurrences, then the phrase itself.

    Null texts are empty, null languages `und`. Repeated rows count as often as they come; identifiers and further
    columns do not matter. Languages without such a phrase, and empty tables, have no rows. `top` None: all phrases.
    """
    if not 2 <= longest <= 3:
        raise ValueError("phrases have 2 or 3 words")
    ship(spark)
    staged = Staged(spark)
    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    known, totals, frequent = None, None, []
    for width in range(1, longest + 1):
        counted, often = phrase_counts(rows, width, known, held, words), F.col("n") >= least
        counted = staged.write(f"counts-{width}", counted if width == 1 else counted.where(often))
        if width == 1:
            totals = counted.groupBy("lang").agg(F.sum("n").alias("total"))
            counted = counted.where(often)
        frequent.append(counted.select("lang", F.lit(width).alias("width"), "phrase", F.col("n").alias("a")))
        if width < longest:
            known = _filter(spark, counted, width)
    return _ranked(staged.write("frequent", reduce(DataFrame.unionByName, frequent)), totals, percent, top)


def _ranked(frequent: DataFrame, totals: DataFrame, percent: int, top: int | None) -> DataFrame:
    """Scores and ranks from the counts of all phrases (lang, width, phrase, a) that reach the least count."""
    candidates = frequent.where("width > 1")
    cuts = candidates.select("*", F.explode(F.sequence(F.lit(1), F.col("width") - 1)).alias("k")).withColumns(
        {"left": F.expr("substring_index(phrase, ' ', k)"), "right": F.expr("substring_index(phrase, ' ', k - width)")}
    )
    for side, count in (("left", "l"), ("right", "r")):
        cuts = cuts.join(frequent.select("lang", F.col("phrase").alias(side), F.col("a").alias(count)), ["lang", side])
    exact = lambda name: f"cast({name} as decimal(19,0))"
    score = F.expr(f"cast(cast(1000000 as decimal(7,0)) * {exact('a')} * {exact('a')} as decimal(38,0)) div ({exact('l')} * {exact('r')})")
    lowest = cuts.withColumn("score", score).groupBy("lang", "phrase", "width", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    # Phrases of fewer words inside longer ones, with the most occurrences of any of those.
    inside = (
        candidates.where("width > 2")
        .select("lang", F.col("a").alias("longer"), F.explode(F.expr("flatten(transform(sequence(2, width - 1), m -> transform(sequence(1, width - m + 1), i -> array_join(slice(split(phrase, ' '), i, m), ' '))))")).alias("phrase"))
        .groupBy("lang", "phrase")
        .agg(F.max("longer").alias("longer"))
    )
    kept = lowest.join(inside, ["lang", "phrase"], "left").where(F.coalesce(100 * F.col("longer") < percent * F.col("a"), F.lit(True)))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    rows = kept.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    ranked = rows.withColumn("rank", F.row_number().over(order))
    if top is not None:
        ranked = ranked.where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", F.col("total").alias("n"), "score")
