"""Spans of a text: building span columns and the strings made from them."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

SPAN_TYPE = "array<struct<kind:string,start:int,end:int>>"
#: Rows that are scanned before their spans are handed on.
SLICE_ROWS = 256


def joined(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def n_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def arrow_scan(scan: Callable[[str], dict], text_col: str, schema: pa.Schema, keep: list[str]):
    """A ``mapInArrow`` function: the kept columns, then for each row the dict
    that ``scan`` makes of its text (a null text is scanned as empty)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE_ROWS):
                rows = batch.slice(start, SLICE_ROWS)
                found = [scan(t or "") for t in rows.column(text_col).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*(rows.column(c) for c in keep), *(pa.array([f[n] for f in found], schema.field(n).type) for n in schema.names)],
                    [*keep, *schema.names])
    return run
