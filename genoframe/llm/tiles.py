"""Work on runs of rows with one key, in bounded memory and without one Python call per small group's Arrow batch."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from genoframe.llm.workers import tidy


def map_runs(df: DataFrame, key: str, apply: Callable[[pa.Table], list[pa.Array] | None], schema: T.StructType) -> DataFrame:
    """Deals ``df`` by the long column ``key`` and calls ``apply`` on the rows of each key; a key's rows must fit a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def done() -> Iterator[pa.RecordBatch]:
            table = pa.Table.from_batches(held).combine_chunks()
            held.clear()
            out = apply(table)
            if out is not None and len(out[0]):
                yield pa.RecordBatch.from_arrays(out, schema.fieldNames())

        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.column(batch.schema.get_field_index(key)).to_numpy(zero_copy_only=False)
            starts = np.flatnonzero(keys[1:] != keys[:-1]) + 1
            for a, b in zip([0, *starts], [*starts, len(keys)], strict=True):
                if held and keys[a] != last:
                    yield from done()
                held.append(batch.slice(a, b - a))
                last = keys[a]
        if held:
            yield from done()

    return df.repartition(key).sortWithinPartitions(key).mapInArrow(tidy(run), schema)
