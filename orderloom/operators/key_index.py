"""Where the keys of a partitioned table are: a side table that an upsert asks before it reads partitions.

The index holds key and partition, dealt by spans of the key into folders and sorted by key within them: a batch
with new and a few old keys reads the spans of these keys alone, and then the partitions that the index names. It
may say too much, never too little: entries are added before the table changes, an entry of a row that has moved
on only costs a look. Entries are appended batch by batch and merged from time to time; a rebuilt table gets a
new index when it is next asked for.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.functions.periods import ordered
from orderloom.sources.lake import Lake

#: Keys that a span holds on average; spans listed in a filter; batches after which entries are merged;
#: folders that a batch may write beyond those that the number of keys accounts for.
SPAN_KEYS, LISTED, MERGE_AFTER, FOLDERS = 4_000_000, 1_000, 16, 64
_SPAN, _KEY = "_span", "key"
_OF = "_of"


@dataclass(frozen=True)
class KeyIndex:
    """The index of one table. `keys` name a row; a single whole number keeps its order, others are hashed."""

    lake: Lake
    table: str
    keys: list[str]
    column: str

    @property
    def name(self) -> str:
        return f"{self.table}_keys"

    def _value(self, df: DataFrame) -> Column:
        whole = (T.LongType, T.IntegerType, T.ShortType)
        if len(self.keys) == 1 and isinstance(df.schema[self.keys[0]].dataType, whole):
            return F.col(self.keys[0]).cast("bigint")
        return F.xxhash64(*self.keys)

    def _about(self) -> dict | None:
        """What the stored index is of, or None if there is none that fits the table as it is."""
        if not self.lake.exists(self.name):
            return None
        path = f"{self.lake.current_path(self.name)}/{_OF}"
        about = json.loads(self.lake.text_of(path)) if self.lake.is_file(path) else {}
        return about if about.get("path") == self.lake.current_path(self.table) else None

    def _ready(self) -> dict:
        return self._about() or self._build()

    def _build(self) -> dict:
        """Index the table as it is: one pass over its keys."""
        rows = self.lake.read(self.table)
        entries = rows.select(self._value(rows).alias(_KEY), self.column)
        return self._deal(entries)

    def _deal(self, entries: DataFrame) -> dict:
        """Store all entries in spans as wide as their number and range ask for."""
        n, low, high = entries.agg(F.count("*"), F.min(_KEY), F.max(_KEY)).first()
        width = (high - low + 1) // max(1, n // SPAN_KEYS) if n else 1
        return self._publish(entries, min(max(1, width), 1 << 62), n)

    def _publish(self, entries: DataFrame, width: int, n: int) -> dict:
        about = {"path": self.lake.current_path(self.table), "width": width, "entries": n}
        spanned = entries.select(_KEY, self.column, _span(width))
        self.lake.publish(self.name, spanned, _SPAN, sort_by=_KEY)
        # Written last: an index without it is built again.
        self.lake.put_text(f"{self.lake.current_path(self.name)}/{_OF}", json.dumps(about))
        return about

    def partitions(self, rows: DataFrame) -> list[dt.date | None]:
        """Partitions that may hold rows with the keys of `rows`."""
        width = self._ready()["width"]
        wanted = rows.select(self._value(rows).alias(_KEY)).withColumn(_SPAN, _span(width))
        spans = [r[0] for r in wanted.select(_SPAN).distinct().limit(LISTED + 1).collect()]
        entries = self.lake.read(self.name)
        if len(spans) <= LISTED:
            entries = entries.where(F.col(_SPAN).isin(spans))
        low, high = wanted.agg(F.min(_KEY), F.max(_KEY)).first()
        entries = entries.where(F.col(_KEY).between(F.lit(low), F.lit(high)))
        found = entries.join(wanted.select(_KEY), _KEY, "left_semi").select(self.column).distinct()
        return ordered(r[0] for r in found.collect())

    def add(self, rows: DataFrame) -> None:
        """Note where these rows will be; to be called before they get there.

        Spans that were laid out for few keys, or for none, would be a folder for every few of these: the index is
        then dealt anew.
        """
        about = self._ready()
        width, known = about["width"], about.get("entries", 0)
        entries = rows.select(self._value(rows).alias(_KEY), self.column)
        spanned = entries.withColumn(_SPAN, _span(width))
        n, spans = spanned.agg(F.count("*"), F.approx_count_distinct(_SPAN)).first()
        if not n:
            return
        stored = self.lake.read(self.name).select(_KEY, self.column)
        if not known or spans > FOLDERS + 2 * (known + n) // SPAN_KEYS:
            self._deal(stored.unionByName(entries).distinct())
            return
        self.lake.append(self.name, spanned, f"added-{uuid.uuid4().hex}", _SPAN, sort_by=_KEY)
        if self.lake.batches(self.name) > MERGE_AFTER:
            merged = self.lake.read(self.name).select(_KEY, self.column).distinct()
            self._publish(merged, width, known + n)


def _span(width: int) -> Column:
    # Rounds down without leaving 64 bits.
    return F.expr(f"{_KEY} div {width}L - cast({_KEY} % {width}L < 0 as int)").alias(_SPAN)
