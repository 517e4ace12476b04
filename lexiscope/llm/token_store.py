"""Token-id store: fixed-size id blocks as zstandard-compressed byte planes with a chunk index.

Documents are range-partitioned by ``doc_id`` and tokenised in that order; one
end id follows each document.  Every partition cuts its id stream into blocks of
``block_ids`` ids.  A block is transposed into planes (four byte planes, or 32
bit planes) and each plane is compressed by itself: the upper planes of small
ids are constant and cost a few bytes.  A row of the store is one block: its
place (``part``, ``block``, ``first`` = ids of the part before it), the planes,
and the chunk index ``docs`` (which document pieces lie where in the block), so a
document is read without touching other blocks.

The store is a Parquet table: Spark's commit protocol makes a retried task
replace its own output, and blocks can lie in any store that Spark reads.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexiscope.llm.common import ready
from lexiscope.llm.tokenise import default_path, texts, tokenizer, until_done
from lexiscope.session import scratch_path

BLOCK_IDS = 1 << 16
END_ID = 1
STORE = ("part int, block int, first long, n_ids int, planes array<binary>, "
         "docs array<struct<doc_id: long, doc: long, piece: int, offset: int, length: int, last: boolean>>")


def to_planes(ids: np.ndarray, bits: bool, pack) -> list[bytes]:
    """Compressed planes of uint32 ids: byte planes, or bit planes if ``bits``."""
    by = np.ascontiguousarray(ids.astype("<u4")).view(np.uint8).reshape(-1, 4).T
    if bits:
        by = np.concatenate([np.packbits((row[None, :] >> np.arange(8, dtype=np.uint8)[:, None]) & 1, axis=1)
                             for row in by])
    return [pack.compress(np.ascontiguousarray(row).tobytes()) for row in by]


def from_planes(planes: list[bytes], n: int, unpack) -> np.ndarray:
    """The uint32 ids of a block; the number of planes tells their kind (4: bytes, 32: bits)."""
    raw = [np.frombuffer(unpack.decompress(p), np.uint8) for p in planes]
    if len(raw) == 32:
        bit = [np.unpackbits(r, count=n) for r in raw]
        raw = [sum(bit[8 * k + j] << np.uint8(j) for j in range(8)).astype(np.uint8) for k in range(4)]
    return np.ascontiguousarray(np.stack(raw, axis=1)).view("<u4").ravel()


def _blocks(path: str, end_id: int, block_ids: int, bits: bool):
    def run(batches):
        part = TaskContext.get().partitionId()
        pack, tok = zstandard.ZstdCompressor(level=1), tokenizer(path)
        end = np.array([end_id], "<u4")
        buf, held, docs, block, first, doc = [], 0, [], 0, 0, 0

        def row():
            ids = np.concatenate(buf) if buf else np.zeros(0, "<u4")
            return {"part": part, "block": block, "first": first, "n_ids": len(ids),
                    "planes": to_planes(ids, bits, pack), "docs": list(docs)}

        out = []
        for batch in batches:
            for doc_id, own in zip(batch.column("doc_id").to_pylist(), texts(tok, batch.column("text"))):
                ids = np.concatenate([own, end])
                at = piece = 0
                while at < len(ids):
                    take = min(len(ids) - at, block_ids - held)
                    buf.append(ids[at:at + take])
                    docs.append({"doc_id": doc_id, "doc": doc, "piece": piece, "offset": held,
                                 "length": take, "last": at + take == len(ids)})
                    at, held, piece = at + take, held + take, piece + 1
                    if held == block_ids:
                        out.append(row())
                        buf, held, docs, block, first = [], 0, [], block + 1, first + block_ids
                        if len(out) == 8:
                            yield pa.RecordBatch.from_pylist(out, SCHEMA)
                            out = []
                doc += 1
        if held:
            out.append(row())
        if out:
            yield pa.RecordBatch.from_pylist(out, SCHEMA)
    return until_done(run, path)


SCHEMA = pa.schema([
    ("part", pa.int32()), ("block", pa.int32()), ("first", pa.int64()), ("n_ids", pa.int32()),
    ("planes", pa.list_(pa.binary())),
    ("docs", pa.list_(pa.struct([("doc_id", pa.int64()), ("doc", pa.int64()), ("piece", pa.int32()),
                                 ("offset", pa.int32()), ("length", pa.int32()), ("last", pa.bool_())])))])


def write_store(docs: DataFrame, path: str | None = None, tokenizer_path: str | None = None,
                end_id: int = END_ID, block_ids: int = BLOCK_IDS, bits: bool = False) -> str:
    """Write the ids of ``docs`` (``doc_id``, ``text``; other columns are ignored); returns the path.

    A null text counts as empty (its end id only); null ids come first; rows with one
    ``doc_id`` are kept apart and ordered by their text's hash (equal rows are
    interchangeable).  An empty table gives an empty store.
    """
    spark = docs.sparkSession
    ready(spark)
    path = path or scratch_path(spark, "token-store")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    order = ["doc_id", F.xxhash64("text")]
    (rows.repartitionByRange(n, *order).sortWithinPartitions(*order)
     .mapInArrow(_blocks(tokenizer_path or default_path(), end_id, block_ids, bits), STORE)
     .write.parquet(path))
    return path


def _pieces(batches):
    unpack = zstandard.ZstdDecompressor()
    for batch in batches:
        rows = []
        for r in batch.to_pylist():
            ids = from_planes(r["planes"], r["n_ids"], unpack)
            for d in r["docs"]:
                cut = ids[d["offset"]:d["offset"] + d["length"]]
                rows.append((r["part"], d["doc"], d["piece"], d["doc_id"], r["first"] + d["offset"],
                             d["length"], cut.tobytes()))
        names = ("part", "doc", "piece", "doc_id", "at", "length", "ids")
        types = (pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.binary())
        cols = list(zip(*rows)) or [()] * 7
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names)


def read_store(spark, path: str) -> DataFrame:
    """Document pieces of a store, decoded: ``part, doc, piece, doc_id, at`` (ids of the part
    before the piece), ``length``, ``ids`` (little-endian unsigned 32-bit)."""
    return spark.read.parquet(path).mapInArrow(
        _pieces, "part int, doc long, piece int, doc_id long, at long, length int, ids binary")


def joined_crc(parts) -> int:
    """crc32 of a concatenation from ``(crc, bytes)`` of its pieces in order: crc32 is linear, so
    running the left crc over as many zero bytes as the right piece has shifts it into place."""
    total = 0
    for crc, n in parts:
        zeros = bytes(n)
        total = zlib.crc32(zeros, total) ^ zlib.crc32(zeros) ^ crc
    return total


def digests(spark, path: str) -> DataFrame:
    """Per stored document: ``doc_id, start`` (ids of all documents before it), ``n_tokens``, ``ids_crc32``."""
    blocks = spark.read.parquet(path)
    # One row per written partition: the only thing ordered in a single task.
    parts = blocks.groupBy("part").agg(F.sum("n_ids").alias("_ids")).select(
        "part", F.coalesce(F.sum("_ids").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)),
                           F.lit(0)).alias("before"))
    pieces = read_store(spark, path).select(
        "part", "doc", "piece", "doc_id", "at", "length", F.crc32("ids").alias("crc"))
    join_crc = F.pandas_udf(lambda s: pd.Series([joined_crc([(p["crc"], 4 * p["length"]) for p in x]) for x in s],
                                                dtype="int64"), "long")
    whole = pieces.groupBy("part", "doc").agg(
        F.first("doc_id").alias("doc_id"), F.min("at").alias("at"), F.sum("length").cast("long").alias("n_tokens"),
        F.array_sort(F.collect_list(F.struct("piece", "crc", "length"))).alias("pieces"))
    return whole.join(F.broadcast(parts), "part").select(
        "doc_id", (F.col("before") + F.col("at")).alias("start"), "n_tokens",
        join_crc("pieces").alias("ids_crc32"))
