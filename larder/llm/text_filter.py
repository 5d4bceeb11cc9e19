"""Row filter by a Python predicate on the text, keeping every column as it is."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame


def keep_where(docs: DataFrame, make: Callable[[], Callable[[str], bool]], column: str = "text") -> DataFrame:
    """Rows whose text passes ``make()``'s predicate (made once per task); NULL text counts as empty."""
    at = docs.columns.index(column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        passes = make()
        for batch in batches:
            yield batch.filter(pa.array([bool(passes(t or "")) for t in batch.column(at).to_pylist()], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
