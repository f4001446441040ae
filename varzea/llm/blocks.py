"""Tables of document blocks, and the compact integers that rounds over blocks exchange."""

from __future__ import annotations

import atexit
import struct
import uuid
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute
import pyarrow.ipc
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from varzea.llm.common import delete_path, new_path

BLOCK_BYTES = 3_000_000


def arrow_payload(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
        w.write_batch(batch)
    return sink.getvalue().to_pybytes()


@dataclass(frozen=True)
class Blocks:
    """A table (block, payload) in the catalog, and its bytes of text."""

    table: DataFrame
    name: str
    path: str
    size: int

    def drop(self) -> None:
        """Take the table out of the catalog and delete its files. Best effort: when the driver ends the JVM may be gone already."""
        spark = self.table.sparkSession
        try:
            spark.sql(f"DROP TABLE IF EXISTS {self.name}")
        except Exception:  # noqa: BLE001
            return
        delete_path(spark, self.path)


def write_blocks(docs: DataFrame, block_bytes: int = BLOCK_BYTES, payload=arrow_payload) -> Blocks:
    """Group whole documents to blocks, a row each, `payload` making bytes of a batch of documents.

    A block's number is a hash of its payload, so a repeated task gives the same blocks; equal blocks share it and get
    equal answers. The table has a file for each shuffle partition, and rounds that are keyed by block shuffle only what
    they exchange. It goes with `drop`, or when the driver ends.
    """
    spark = docs.sparkSession
    fields = pa.schema([("block", pa.int64()), ("n_bytes", pa.int64()), ("payload", pa.binary())])

    def run(batches):
        for batch in batches:
            sizes = pa.compute.binary_length(batch.column("text")).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            begin, total = 0, 0
            for i in range(len(sizes) + 1):
                if i == len(sizes) or (total and total + sizes[i] > block_bytes):
                    if i > begin:
                        made = payload(batch.slice(begin, i - begin))
                        yield pa.RecordBatch.from_pydict({"block": [xxhash.xxh64_intdigest(made) >> 1], "n_bytes": [int(total)], "payload": [made]}, schema=fields)
                    begin, total = i, 0
                if i < len(sizes):
                    total += sizes[i]

    path, name = new_path(spark, "blocks"), f"varzea_blocks_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    made = docs.mapInArrow(run, "block long, n_bytes long, payload binary").repartition(buckets, "block")
    made.write.option("path", path).option("compression", "uncompressed").bucketBy(buckets, "block").saveAsTable(name)
    table = spark.table(name)
    blocks = Blocks(table, name, path, table.agg(F.coalesce(F.sum("n_bytes"), F.lit(0))).first()[0])
    atexit.register(blocks.drop)
    return blocks


def read_block(payload: bytes) -> pa.Table:
    return pa.ipc.open_stream(pa.BufferReader(payload)).read_all().combine_chunks()


def pack(a: np.ndarray) -> bytes:
    """Compress integers, byte plane by byte plane."""
    return zstandard.compress(np.ascontiguousarray(a.view(np.uint8).reshape(len(a), -1).T).tobytes(), 3)


def unpack(b: bytes, kind) -> np.ndarray:
    raw = np.frombuffer(zstandard.decompress(b), dtype=np.uint8)
    return np.ascontiguousarray(raw.reshape(np.dtype(kind).itemsize, -1).T).reshape(-1).view(kind)


def pack_sorted(a: np.ndarray) -> bytes:
    return pack(np.diff(a, prepend=a.dtype.type(0)))


def unpack_sorted(b: bytes, kind) -> np.ndarray:
    return np.cumsum(unpack(b, kind), dtype=kind)


def join_parts(*parts: bytes) -> bytes:
    return struct.pack(f"<{len(parts) + 1}q", len(parts), *map(len, parts)) + b"".join(parts)


def split_parts(b: bytes) -> list[bytes]:
    n = struct.unpack_from("<q", b)[0]
    at, out = 8 * (n + 1), []
    for size in struct.unpack_from(f"<{n}q", b, 8):
        out.append(b[at : at + size])
        at += size
    return out


def bits(a: np.ndarray) -> bytes:
    return np.packbits(a.astype(bool)).tobytes()


def unbits(b: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(b, dtype=np.uint8), count=n).astype(bool)


def frame(columns: list[str], rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=columns)
