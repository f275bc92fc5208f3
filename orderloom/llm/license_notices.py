"""Licence notices in texts: phrases of words, and short notices with a few characters wrong.

A notice is looked for in the text's words, joined by single blanks, so that case, punctuation and line breaks do
not matter. With at most k wrong characters, one of k + 1 parts of a notice stands in the text as it is: an
automaton finds all parts of all notices in one pass, and only there the notice is matched, with its bound on errors,
in a window that holds every match with that part. What matches is mapped back to the text's own code points.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm.common import id_text, texts_of

# Fixed values of the contract: phrases whose words must stand one after the other, and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Wordings of well-known licences, as lower-case words.
NOTICES = {
    "agpl": ["gnu affero general public license"],
    "all-rights-reserved": ["all rights reserved"],
    "apache": [
        "licensed under the apache license version 2 0",
        "you may not use this file except in compliance with the license",
    ],
    "boost": ["distributed under the boost software license version 1 0"],
    "bsd": [
        "redistribution and use in source and binary forms with or without modification are permitted",
        "neither the name of the copyright holder nor the names of its contributors may be used to endorse",
    ],
    "cc-by": [
        "licensed under a creative commons attribution 4 0 international license",
        "licensed under cc by 4 0",
    ],
    "cc-by-nc": ["creative commons attribution noncommercial", "licensed under cc by nc 4 0"],
    "cc-by-nc-nd": ["licensed under cc by nc nd 4 0"],
    "cc-by-nc-sa": ["licensed under cc by nc sa 4 0"],
    "cc-by-nd": ["creative commons attribution noderivatives", "licensed under cc by nd 4 0"],
    "cc-by-sa": ["creative commons attribution sharealike", "licensed under cc by sa 4 0"],
    "cc0": ["cc0 1 0 universal public domain dedication"],
    "epl": ["terms of the eclipse public license"],
    "gpl": ["gnu general public license"],
    "isc": ["permission to use copy modify and or distribute this software for any purpose with or without fee"],
    "lgpl": ["gnu lesser general public license"],
    "mit": [
        "released under the mit license",
        "licensed under the mit license",
        "permission is hereby granted free of charge to any person obtaining a copy",
    ],
    "mpl": ["subject to the terms of the mozilla public license"],
    "unlicense": ["free and unencumbered software released into the public domain"],
}

#: One wrong character (changed, missing or added) for so many of a notice, and the most that are borne.
CHARS_PER_EDIT, MOST_EDITS = 9, 4

_FOLD = bytearray(b" " * 128 + bytes(range(128, 256)))
for _kept in (*range(48, 58), *range(97, 123)):
    _FOLD[_kept] = _kept
_FOLD[65:91] = bytes(range(97, 123))
_FOLD = bytes(_FOLD)


class Found(NamedTuple):
    """A notice in a text: its code points (end exclusive), wrong characters, and the notice's length."""

    label: str
    start: int
    end: int
    edits: int
    length: int


def edits_for(notice: str) -> int:
    return min(MOST_EDITS, len(notice) // CHARS_PER_EDIT)


def _parts(notice: str, edits: int) -> Iterator[tuple[int, str]]:
    """The notice in edits + 1 parts of like length, with their places."""
    cuts = [len(notice) * i // (edits + 1) for i in range(edits + 2)]
    for a, b in zip(cuts, cuts[1:]):
        yield a, notice[a:b]


@lru_cache(1)
def _prepared():
    """Labels, lengths, edits and patterns of the notices, and the automaton of their parts."""
    notices = [(label, notice, edits_for(notice)) for label, wordings in NOTICES.items() for notice in wordings]
    seeds: dict[str, list[tuple[int, int]]] = {}
    for number, (_, notice, edits) in enumerate(notices):
        for at, part in _parts(notice, edits):
            seeds.setdefault(part, []).append((number, at))
    automaton = ahocorasick.Automaton()
    for part, places in seeds.items():
        automaton.add_word(part, (len(part), places))
    automaton.make_automaton()
    patterns = [regex.compile(f"(?e)(?:{regex.escape(notice)}){{e<={edits}}}") for _, notice, edits in notices]
    return notices, patterns, automaton


def words_of(text: str) -> list[str]:
    """Words of a text: runs of digits, letters (A to Z lowered) and all beyond ASCII."""
    return text.encode("utf-8", "surrogatepass").translate(_FOLD).decode("utf-8", "surrogatepass").split(" ") if text else []


def base_places(joined: str) -> list[tuple[str, int]]:
    """Label and first word (from 0) of every place of a phrase in words joined by single blanks, by word."""
    padded, found = f" {joined} ", []
    for phrase, label in PHRASES.items():
        wanted, at = f" {phrase} ", padded.find(f" {phrase} ")
        while at >= 0:
            found.append((at, label))
            at = padded.find(wanted, at + 1)
    found.sort()
    out, upto, word = [], 0, 0
    for at, label in found:  # counted on from place to place: linear in the text
        word += padded.count(" ", upto, at)
        upto = at
        out.append((label, word))
    return out


def _windows(joined: str) -> dict[int, list[tuple[int, int]]]:
    """For each notice, stretches of the text that hold every match of it; touching ones are one."""
    notices, _, automaton = _prepared()
    windows: dict[int, list[tuple[int, int]]] = {}
    for last, (size, places) in automaton.iter(joined):
        for number, offset in places:
            _, notice, edits = notices[number]
            start = last + 1 - size - offset
            a, b = max(0, start - edits), min(len(joined), start + len(notice) + edits)
            own = windows.setdefault(number, [])
            # Parts end in the order of the text, their windows begin nearly so.
            while own and own[-1][1] >= a:
                x, y = own.pop()
                a, b = min(a, x), max(b, y)
            own.append((a, b))
    return windows


def notices_in(joined: str) -> list[Found]:
    """Notices in words joined by single blanks, with places in that string; see `find`."""
    notices, patterns, _ = _prepared()
    found = []
    for number, windows in _windows(joined).items():
        label, notice, _ = notices[number]
        for a, b in windows:
            for match in patterns[number].finditer(joined, a, b):
                found.append(Found(label, match.start(), match.end(), sum(match.fuzzy_counts), len(notice)))
    # Of notices that overlap by half of one, those with fewer errors stay (then the longer, then the first label).
    kept: list[Found] = []
    by_place = sorted(found, key=lambda f: (f.start, f.end))
    clusters: list[list[Found]] = []
    reach = -1
    for f in by_place:
        if f.start >= reach:
            clusters.append([])
        clusters[-1].append(f)
        reach = max(reach, f.end)
    for cluster in clusters:
        chosen: list[Found] = []
        for f in sorted(cluster, key=lambda f: (f.edits / f.length, -f.length, f.label, f.start)):
            if all(2 * (min(f.end, g.end) - max(f.start, g.start)) < min(f.end - f.start, g.end - g.start) for g in chosen):
                chosen.append(f)
        kept += chosen
    return sorted(kept, key=lambda f: (f.start, f.end, f.label))


def _origin(text: str) -> np.ndarray:
    """Place in `text` of every character of its joined words; of a blank, that of the character before it, plus one."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    ascii_word = np.frombuffer(_FOLD[:128], np.uint8) != 32
    at = np.flatnonzero((points >= 128) | ascii_word[np.minimum(points, 127)])
    if not len(at):
        return at
    return np.insert(at, np.flatnonzero(np.diff(at) > 1) + 1, at[:-1][np.diff(at) > 1] + 1)


def find(text: str) -> tuple[int, list[tuple[str, int]], list[Found]]:
    """Number of words, places of the phrases (label, first word), and notices with places in `text` itself.

    Every notice that stands in the text with at most `edits_for` wrong characters is found, unless a notice with
    fewer errors for its length covers half of it. An empty text has no words and nothing in it.
    """
    words = [w for w in words_of(text) if w]
    joined = " ".join(words)
    notices = notices_in(joined)
    if notices:
        origin = _origin(text)
        notices = [f._replace(start=int(origin[f.start]), end=int(origin[f.end - 1]) + 1) for f in notices]
    return len(words), base_places(joined), notices


_ROW = "n_words long, base array<struct<label string, word long>>, notices array<struct<label string, start long, end long, edits long, length long>>"
_BASE = pa.list_(pa.struct([("label", pa.string()), ("word", pa.int64())]))
_NOTICE = pa.list_(pa.struct([("label", pa.string()), *((n, pa.int64()) for n in ("start", "end", "edits", "length"))]))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of `docs`: doc_id, n_words, base (label, first word), notices (label, start, end, edits, length).

    Null texts are empty. Null and repeated identifiers are rows like any other; further columns do not matter.
    """
    source = id_text(docs, id_col, text_col)
    kind = source.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            count, base, notices = [], [], []
            for text in texts_of(batch.column("text")):
                n, places, found = find(text)
                count.append(n)
                base.append([{"label": label, "word": word} for label, word in places])
                notices.append([f._asdict() for f in found])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(count, pa.int64()), pa.array(base, _BASE), pa.array(notices, _NOTICE)], ["doc_id", "n_words", "base", "notices"]
            )

    return source.mapInArrow(run, f"doc_id {kind}, {_ROW}")


def summary(scanned: DataFrame) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans of every row of `scan`.

    score: 1 where a phrase stands, else the best share of right characters of a notice, else 0. spans: the notices
    as label:start:end:edits.
    """
    labels = lambda *columns: F.array_join(F.array_sort(F.array_distinct(F.concat(*(F.col(f"{c}.label") for c in columns)))), ",")
    right = F.transform("notices", lambda s: 1 - s["edits"].cast("double") / s["length"])
    return scanned.select(
        "doc_id",
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min("base.word").alias("first_word"),
        F.array_max("base.word").alias("last_word"),
        labels("base").alias("base_labels"),
        labels("base", "notices").alias("labels"),
        F.when(F.size("base") > 0, F.lit(1.0)).otherwise(F.coalesce(F.array_max(right), F.lit(0.0))).alias("score"),
        F.array_join(F.transform("notices", lambda s: F.concat_ws(":", s["label"], s["start"], s["end"], s["edits"])), ",").alias("spans"),
    )
