"""Arrow IPC payloads held as binary values.

``encode_payloads`` turns each batch of rows into one IPC payload (a binary
value) next to its row count; ``decode_payloads`` turns payload values back
into rows. Both run in Python over Arrow batches; each payload holds one
bounded batch (see ``operators.batches.fixed_size_batches``), never a table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.arrow_types import cast_batch, relaxed, to_arrow_schema

PAYLOAD_SCHEMA = "batch bigint, n bigint, payload binary"


def encode_payloads(df: DataFrame, batch: str = "batch", flavor: str = "stream",
                    compression: str | None = None, order_by: str | None = None) -> DataFrame:
    """One (batch, n, payload) row per batch value. With ``order_by`` the rows
    inside a payload are sorted by it, so a retried task writes the same
    bytes; otherwise they keep the order the shuffle delivers."""
    cols = [c for c in df.columns if c != batch]
    # Field metadata (type names) is carried by the schema built here: Arrow
    # batches handed to Python do not keep it.
    target = relaxed(to_arrow_schema(T.StructType([df.schema[c] for c in cols])))

    def encode(table):
        import pyarrow as pa
        from tessera.sources.arrow_ipc import encode_ipc
        key = table.column(batch)[0].as_py() if table.num_rows else None
        if order_by:
            table = table.sort_by(order_by)
        body = table.select(cols).combine_chunks()
        batches = [cast_batch(b, target) for b in body.to_batches()]
        data = encode_ipc(batches, target, flavor, compression)
        return pa.table({"batch": pa.array([key], pa.int64()),
                         "n": pa.array([table.num_rows], pa.int64()),
                         "payload": pa.array([data], pa.binary())})

    return df.groupBy(batch).applyInArrow(encode, PAYLOAD_SCHEMA)


def encode_payloads_per_task(df: DataFrame, flavor: str = "stream",
                             compression: str | None = None) -> DataFrame:
    """No shuffle: one payload per Arrow batch Spark streams to Python
    (``spark.sql.execution.arrow.maxRecordsPerBatch`` rows at most)."""
    target = relaxed(to_arrow_schema(df.schema))

    def encode(batches):
        import pyarrow as pa
        from tessera.sources.arrow_ipc import encode_ipc
        for b in batches:
            if b.num_rows == 0:
                continue
            data = encode_ipc([cast_batch(b, target)], target, flavor, compression)
            yield pa.RecordBatch.from_pydict({"n": [b.num_rows], "payload": [data]},
                                             schema=pa.schema([("n", pa.int64()),
                                                               ("payload", pa.binary())]))

    return df.mapInArrow(encode, "n bigint, payload binary")


def decode_payloads(df: DataFrame, schema: T.StructType, payload: str = "payload") -> DataFrame:
    """Rows of every payload, cast to ``schema`` (Arrow names matched)."""
    target = relaxed(to_arrow_schema(schema))
    names = [f.name for f in schema.fields]

    def decode(batches):
        from tessera.sources.arrow_ipc import iter_ipc_batches
        for b in batches:
            for data in b.column(0).to_pylist():
                if data is None:
                    continue
                for rb in iter_ipc_batches(data):
                    yield cast_batch(rb.select(names), target)

    return df.select(payload).mapInArrow(decode, schema)


def payload_bytes(payload: str = "payload"):
    return F.octet_length(F.col(payload))
