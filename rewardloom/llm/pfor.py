"""Token ids in patched frame-of-reference blocks.

A segment holds some whole documents' ids in a row.  Its bytes, all little-endian:

    "PFR1" | ids uint64 | blocks uint32 | exceptions uint32
    | block starts uint32 x blocks   (place of each block's words in the packed area, in 4-byte words)
    | block minimum uint32 x blocks | width uint8 x blocks | exceptions of each block uint8 x blocks
    | exception places uint8 x exceptions | exception values uint32 x exceptions | packed words uint32

A block is 128 ids (the last one is filled up with its minimum).  The minimum is subtracted, and the
differences are packed in as many bits as the 90th percentile of them needs; a difference that needs
more bits keeps its low bits in place, and its whole value stands in the exception list.  A block's
words are found by its start, so any id can be read without unpacking what is before it.

The table of segments is Parquet written and read by Spark, so it lives wherever the cluster's shared
folder does and a lost task leaves no half-written file: columns part, segment, before (ids in the part's earlier
segments), ids, doc_ids, lengths, payload.  Documents go by ascending id (nulls first, then by a hash of the text): one range shuffle,
whose partitions are written as they are sorted.

Defined cases: null text is the empty text (the end id alone); repeated rows are written each; an
empty table gives no segments; other columns aren't read.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from rewardloom.llm.tokens import encoded
from rewardloom.session import scratch_path

BLOCK, MAGIC = 128, b"PFR1"
SEGMENTS = "part long, segment long, before long, ids long, doc_ids array<long>, lengths array<long>, payload binary"


def _widths(x: np.ndarray) -> np.ndarray:
    """Bits that each value needs."""
    return np.where(x > 0, np.floor(np.log2(np.maximum(x, 1).astype(np.float64))).astype(np.int64) + 1, 0)


def _pack(values: np.ndarray, width: int) -> np.ndarray:
    """(k, 128) values under 2**width as (k, 4 * width) words; 32 values share width words."""
    v = np.ascontiguousarray(values.reshape(-1, 32).T).astype(np.uint64)       # row i: the i-th of each 32
    out = np.zeros((width + 1, v.shape[1]), np.uint64)
    for i in range(32):
        word, bit = divmod(i * width, 32)
        moved = v[i] << np.uint64(bit)
        out[word] |= moved & np.uint64(0xFFFFFFFF)
        out[word + 1] |= moved >> np.uint64(32)
    return out[:width].T.astype("<u4").reshape(len(values), 4 * width)


def _unpack(words: np.ndarray, width: int) -> np.ndarray:
    w = np.zeros((width + 1, 4 * len(words)), np.uint64)
    w[:width] = words.reshape(-1, width).T
    out = np.empty((32, w.shape[1]), np.uint32)
    mask = np.uint64((1 << width) - 1)
    for i in range(32):
        word, bit = divmod(i * width, 32)
        both = w[word] | (w[word + 1] << np.uint64(32))
        out[i] = (both >> np.uint64(bit)) & mask
    return out.T.reshape(len(words), BLOCK)


def encode(ids: np.ndarray, percentile: float = 0.9) -> bytes:
    """A segment's bytes."""
    n = len(ids)
    blocks = -(-n // BLOCK)
    if not n:
        return MAGIC + struct.pack("<QII", 0, 0, 0)
    a = np.full(blocks * BLOCK, ids[-1], np.uint32)
    a[:n] = ids
    a = a.reshape(blocks, BLOCK)
    low = a.min(axis=1)
    rest = a - low[:, None]
    rank = min(BLOCK - 1, int(np.ceil(percentile * BLOCK)) - 1)
    width = _widths(np.partition(rest, rank, axis=1)[:, rank])
    out = (rest.astype(np.uint64) >> width.astype(np.uint64)[:, None]) != 0
    where, place = np.nonzero(out)
    starts = np.concatenate([[0], np.cumsum(4 * width)])
    packed = np.zeros(int(starts[-1]), "<u4")
    for w in np.unique(width[width > 0]):
        rows = np.nonzero(width == w)[0]
        words = _pack(rest[rows] & np.uint32((1 << int(w)) - 1), int(w))
        packed[(starts[rows][:, None] + np.arange(4 * int(w))).ravel()] = words.ravel()
    return b"".join([MAGIC, struct.pack("<QII", n, blocks, len(where)), starts[:-1].astype("<u4").tobytes(),
                     low.astype("<u4").tobytes(), width.astype(np.uint8).tobytes(),
                     out.sum(axis=1).astype(np.uint8).tobytes(), place.astype(np.uint8).tobytes(),
                     rest[where, place].astype("<u4").tobytes(), packed.tobytes()])


def decode(data: bytes) -> np.ndarray:
    """The ids of a segment's bytes."""
    if data[:4] != MAGIC:
        raise ValueError("not a segment")
    n, blocks, exceptions = struct.unpack_from("<QII", data, 4)
    at = 20

    def take(kind, count):
        nonlocal at
        out = np.frombuffer(data, kind, count, at)
        at += out.nbytes
        return out

    starts, low = take("<u4", blocks), take("<u4", blocks)
    width, patched = take(np.uint8, blocks), take(np.uint8, blocks)
    place, value = take(np.uint8, exceptions), take("<u4", exceptions)
    packed = np.frombuffer(data, "<u4", offset=at)
    rest = np.zeros((blocks, BLOCK), np.uint32)
    for w in np.unique(width[width > 0]):
        rows = np.nonzero(width == w)[0]
        rest[rows] = _unpack(packed[(starts[rows].astype(np.int64)[:, None] + np.arange(4 * int(w)))], int(w))
    rest[np.repeat(np.arange(blocks), patched), place] = value
    return (rest + low[:, None]).ravel()[:n]


def write_ids(docs: DataFrame, path: str, tokenizer: str, spaces: str, end: int = 2, segment_ids: int = 1 << 17) -> None:
    """Writes the table of segments to ``path``."""
    schema = pa.schema([("part", pa.int64()), ("segment", pa.int64()), ("before", pa.int64()), ("ids", pa.int64()), ("doc_ids", pa.list_(pa.int64())),
                        ("lengths", pa.list_(pa.int64())), ("payload", pa.binary())])

    def run(batches):
        part, number, before, docs_in, parts = TaskContext.get().partitionId(), 0, 0, [], []

        def flush():
            lengths = [len(x) // 4 for x in parts]
            payload = encode(np.frombuffer(b"".join(parts), "<u4"))
            row = [[part], [number], [before], [sum(lengths)], [list(docs_in)], [lengths], [payload]]
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(row, schema)], schema=schema)

        held = 0
        for (doc,), ids in encoded(batches, tokenizer, spaces, end):
            docs_in.append(doc)
            parts.append(ids)
            held += len(ids) // 4
            if held >= segment_ids:
                yield flush()
                number, before, held, docs_in, parts = number + 1, before + held, 0, [], []
        if parts:
            yield flush()

    (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
         .withColumn("h", F.xxhash64("text"))
         .repartitionByRange("doc_id", "h").sortWithinPartitions("doc_id", "h").drop("h")
         .mapInArrow(run, SEGMENTS).write.parquet(path))


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """Per document of a table of segments: doc_id, start (ids of all documents before it), n_tokens,
    ids_crc32, from the decoded segments."""
    segments = spark.read.parquet(path)
    # one row per partition that wrote (a task): a small table, so payloads stay where they are
    sizes = segments.groupBy("part").agg(F.sum("ids").alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("part_start"))
    schema = pa.schema([(n, pa.int64()) for n in ("doc_id", "start", "n_tokens", "ids_crc32")])

    def run(batches):
        for batch in batches:
            for x in batch.to_pylist():
                data = decode(x["payload"]).astype("<u4").tobytes()
                ends = np.cumsum(x["lengths"]) if x["lengths"] else np.zeros(0, np.int64)
                begins = ends - np.array(x["lengths"], np.int64)
                crc = [zlib.crc32(data[4 * a:4 * b]) for a, b in zip(begins.tolist(), ends.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x["doc_ids"], pa.int64()), pa.array(begins + x["start"], pa.int64()),
                     pa.array(x["lengths"], pa.int64()), pa.array(crc, pa.int64())], schema=schema)

    placed = segments.join(F.broadcast(sizes), "part").select((F.col("part_start") + F.col("before")).alias("start"), "doc_ids", "lengths", "payload")
    return placed.mapInArrow(
        run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def encode_and_read(docs: DataFrame, tokenizer: str, spaces: str) -> DataFrame:
    path = scratch_path(docs.sparkSession, "token-blocks")
    write_ids(docs, path, tokenizer, spaces)
    return read_ids(docs.sparkSession, path)
