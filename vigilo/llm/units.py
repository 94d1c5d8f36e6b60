"""Documents packed into units of a few megabytes, which several jobs read in turn."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigilo.llm.common import text_bytes
from vigilo.sources.tables import stage

#: Bytes of text in a unit; one longer text is a unit of its own.
UNIT_BYTES = 4 << 20


def _pack(batches):
    import pyarrow as pa

    ids, texts, rest, size = [], [], [], 0

    def row():
        lengths = np.array([len(t) for t in texts], dtype=np.int64)
        known = np.array([k is not None for k in ids], dtype=np.uint8)
        keys = np.array([k or 0 for k in ids], dtype=np.int64)
        data = pa.compress(b"".join(texts), codec="zstd", asbytes=True) if size else b""
        sink = pa.BufferOutputStream()
        if rest[0].num_columns:
            with pa.ipc.new_stream(sink, rest[0].schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
                writer.write_table(pa.Table.from_batches(rest).combine_chunks())
        return pa.RecordBatch.from_arrays(
            [pa.array([x], pa.binary()) for x in (keys.tobytes(), known.tobytes(), lengths.tobytes(), data, sink.getvalue().to_pybytes())]
            + [pa.array([int(lengths.sum())], pa.int64())], names=["ids", "known", "lengths", "data", "rest", "size"])

    for batch in batches:
        # A unit takes whole slices, so it passes its size by one slice at most.
        for at in range(0, batch.num_rows, 64):
            part = batch.slice(at, 64)
            ids += part.column(0).to_pylist()
            new = text_bytes(part.column(1))
            texts += new
            rest.append(part.select(list(range(2, part.num_columns))))
            size += sum(map(len, new))
            if size >= UNIT_BYTES:
                yield row()
                ids, texts, rest, size = [], [], [], 0
    if ids:
        yield row()


class Unit:
    def __init__(self, row: dict):
        import pyarrow as pa

        self.ids = np.frombuffer(row["ids"], dtype=np.int64)
        self.known = np.frombuffer(row["known"], dtype=np.uint8).astype(bool)
        self.lengths = np.frombuffer(row["lengths"], dtype=np.int64)
        self.text = pa.decompress(row["data"], row["size"], codec="zstd", asbytes=True) if row["size"] else b""
        self.raw = np.frombuffer(self.text, dtype=np.uint8)

    @staticmethod
    def carried(row: dict):
        """The other columns of a unit's documents as one Arrow batch; None if nothing is carried."""
        import pyarrow as pa

        if not row["rest"]:
            return None
        return pa.ipc.open_stream(row["rest"]).read_all().combine_chunks().to_batches()[0]


def unit_rows(batches):
    for batch in batches:
        for at in range(batch.num_rows):
            yield batch.slice(at, 1).to_pylist()[0]


def planes(numbers: np.ndarray) -> bytes:
    """Bytes of numbers, all first bytes first: high bytes that are mostly zero then lie together."""
    return numbers.view(np.uint8).reshape(len(numbers), -1).T.tobytes()


def unplanes(data: bytes, kind) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, dtype=np.uint8).reshape(width, -1).T).reshape(-1).view(kind)


def squeeze(*blobs: bytes) -> bytes:
    """Blobs one after the other, compressed, with their length in front."""
    import pyarrow as pa

    data = b"".join(blobs)
    return len(data).to_bytes(8, "little") + pa.compress(data, codec="zstd", asbytes=True)


def unsqueeze(blob: bytes) -> bytes:
    import pyarrow as pa

    return pa.decompress(blob[8:], int.from_bytes(blob[:8], "little"), codec="zstd", asbytes=True)


def pack_units(docs: DataFrame, key: str, text: str, carry: Sequence[str] = ()) -> tuple[DataFrame, int]:
    """Units (``unit``, packed ids, lengths, texts and carried columns) in the shared folder, and the bytes of all texts.

    The number of a unit is written with it, so that jobs can send answers back to units.
    """
    more = [F.col(f"`{c}`").alias(f"carried{k}") for k, c in enumerate(carry)]
    base = docs.select(F.col(key).cast("long").alias("id"), F.col(text).cast("string").alias("text"), *more)
    packed = base.mapInArrow(_pack, "ids binary, known binary, lengths binary, data binary, rest binary, size long")
    units = stage(packed.withColumn("unit", F.monotonically_increasing_id()), "units")
    return units, units.agg(F.sum("size")).first()[0] or 0
