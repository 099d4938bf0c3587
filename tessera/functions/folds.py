"""User-written accumulation over batches (U4).

A fold is split the way Spark aggregates: ``step`` runs in Python once per
Arrow batch and returns that batch's partial state (a dict of numbers);
the partials are merged by Spark aggregate functions (``combine``), with
map-side partial aggregation, and ``finish`` turns the merged state into the
result. The answer does not depend on how rows are cut into batches as long
as ``combine`` is associative (sum, min, max, ...).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_COMBINE = {"sum": F.sum, "min": F.min, "max": F.max, "count": F.sum}


def fold_batches(df: DataFrame, step: Callable, state: T.StructType,
                 combine: dict[str, str], finish: dict[str, Column] | None = None) -> DataFrame:
    """Fold ``df`` batch by batch.

    ``step(batch: pyarrow.RecordBatch) -> dict`` gives the partial state of a
    batch with ``state``'s fields. ``combine`` names the merge per field
    (``sum``, ``min``, ``max``). ``finish`` adds result columns computed from
    the merged fields.
    """
    names = [f.name for f in state.fields]
    missing = set(combine) - set(names)
    if missing:
        raise ValueError(f"combine names fields not in state: {sorted(missing)}")

    def run(batches):
        import pyarrow as pa
        from tessera.sources.arrow_types import relaxed, to_arrow_schema
        target = relaxed(to_arrow_schema(state))
        for b in batches:
            if b.num_rows == 0:
                continue
            part = step(b)
            yield pa.RecordBatch.from_pylist([{n: part.get(n) for n in names}], schema=target)

    partials = df.mapInArrow(run, state)
    merged = partials.agg(*[_COMBINE[how](F.col(name)).alias(name) for name, how in combine.items()])
    if finish:
        merged = merged.withColumns(finish)
    return merged
