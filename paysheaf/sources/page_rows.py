"""Captured pages -> rows of facts: one function of a page, run inside the tasks over Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Pages that a worker turns into Python strings at once.
PAGES_AT_ONCE = 256


def page_rows(pages: DataFrame, keep: list[str], html: str, facts: str, read: Callable[[str | None], Iterable[tuple]]) -> DataFrame:
    """The columns ``keep`` of each page with every row of ``facts`` (a DDL schema) that ``read`` finds on it."""
    added = T.StructType.fromDDL(facts)
    schema = T.StructType([*(pages.schema[c] for c in keep), *added])
    kinds = {T.StringType: pa.string(), T.IntegerType: pa.int32(), T.BooleanType: pa.bool_()}
    own = [pa.list_(pa.string()) if isinstance(f.dataType, T.ArrayType) else kinds[type(f.dataType)] for f in added]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, PAGES_AT_ONCE):
                part = batch.slice(lo, PAGES_AT_ONCE)
                at, rows = [], []
                for i, page in enumerate(part.column(len(keep)).to_pylist()):
                    found = list(read(page))
                    rows += found
                    at += [i] * len(found)
                facts_of = zip(*rows) if rows else [()] * len(own)
                kept = [part.column(k).take(pa.array(at, pa.int64())) for k in range(len(keep))]
                yield pa.RecordBatch.from_arrays([*kept, *(pa.array(c, t) for c, t in zip(facts_of, own))], names=schema.fieldNames())

    return pages.select(*keep, pages[html].alias("_html")).mapInArrow(run, schema)
