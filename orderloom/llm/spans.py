"""Spans found in texts: one row per document, and what is derived from them in Spark."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.llm.common import id_text, texts_of

_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_())])
#: kind, start, end (code points, end exclusive), and whether the plain pattern finds it.
Span = tuple[str, int, int, bool]


def find_spans(docs: DataFrame, find: Callable[[str], list[Span]], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and spans (array of kind, start, end, base) of every row, in the order `find` gives them."""
    source = id_text(docs, id_col, text_col)
    kind = source.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            found = [[dict(zip(("kind", "start", "end", "base"), s)) for s in find(t)] for t in texts_of(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.list_(_SPAN))], ["doc_id", "spans"])

    return source.mapInArrow(run, f"doc_id {kind}, spans array<struct<kind string, start int, end int, base boolean>>")


def replace_spans(docs: DataFrame, find: Callable[[str], list[Span]], mask: Callable[[str], str], text_col: str = "text") -> DataFrame:
    """`docs` with every span in the text replaced by the mask of its kind; overlapping spans become one.

    All columns stay, in their order; a null text stays null.
    """
    id_text(docs, text_col, text_col)  # ships the package
    names = docs.columns
    at = names.index(text_col)

    def run(batches):
        for batch in batches:
            out = []
            for text in batch.column(at).to_pylist():
                if text:
                    parts, upto = [], 0
                    for kind, start, end, _ in sorted(find(text), key=lambda s: (s[1], -s[2])):
                        if start >= upto:
                            parts += [text[upto:start], mask(kind)]
                        upto = max(upto, end)
                    text = "".join([*parts, text[upto:]]) if parts else text
                out.append(text)
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string()) if i == at else c for i, c in enumerate(batch.columns)], names)

    return docs.mapInArrow(run, docs.schema)


def listed(spans: Column | str, base_only: bool = False) -> Column:
    """`kind:start:end` of each span, comma-joined."""
    chosen = F.filter(spans, lambda s: s["base"]) if base_only else spans
    return F.array_join(F.transform(chosen, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def counted(spans: Column | str, kind: str) -> Column:
    """How many spans of this kind the plain pattern finds."""
    return F.size(F.filter(spans, lambda s: s["base"] & (s["kind"] == kind))).cast("long")
