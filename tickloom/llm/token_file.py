"""Token-id files of patched frame-of-reference blocks, written and read by Spark.

The ids of all documents, in ascending id order, are one long sequence. Each range partition
of documents becomes a shard; a shard's rows are segments of whole documents, with

- ``payload``: blocks of ``BLOCK`` ids. A block stores its minimum, the ids less the minimum
  packed in ``width`` bits, and a list of exceptions (place, high bits) for ids that need
  more; ``width`` holds ``PERCENTILE`` percent of the block's ids.
- ``starts``: the byte where each block starts, so that any id can be read by itself.
- ``doc_ids``, ``doc_lengths``: the documents in order and how many ids each has.

Segments are rows of a Parquet table in a folder all executors share: Spark's writer commits
them, so a lost executor leaves no half-written file, and any store Spark knows will do.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.taskcontext import TaskContext

from tickloom.llm.common import batches_of_bytes
from tickloom.llm.tokens import encoder

BLOCK = 256
PERCENTILE = 95
SEGMENT_BYTES = 4_000_000
#: Block header: minimum (4 bytes), ids (2), width (1), unused (1), exceptions (2), unused (2).
HEADER = np.dtype([("least", "<u4"), ("n", "<u2"), ("width", "u1"), ("pad", "u1"), ("odd", "<u2"), ("pad2", "<u2")])
EXCEPTION = np.dtype([("place", "<u2"), ("high", "<u4")])

SEGMENT_SCHEMA = "shard int, segment int, n_ids long, starts binary, payload binary, doc_ids array<long>, doc_lengths array<long>"


def _pack_rows(values: np.ndarray, width: int) -> np.ndarray:
    """Rows of numbers below 2**width as rows of bytes, lowest bit first."""
    lane = 2 if width <= 16 else 4  # bytes spread into bits
    raw = np.unpackbits(values.astype(f"<u{lane}").view(np.uint8).reshape(*values.shape, lane), axis=-1, bitorder="little")
    bits = np.ascontiguousarray(raw[..., :width]).reshape(len(values), -1)
    return np.packbits(bits, axis=1, bitorder="little")


def _unpack_rows(raw: np.ndarray, width: int, n: int) -> np.ndarray:
    bits = np.unpackbits(raw, axis=1, bitorder="little", count=n * width).reshape(len(raw), n, width)
    lane = 2 if width <= 16 else 4
    out = np.zeros((len(raw), n, 8 * lane), np.uint8)
    out[..., :width] = bits
    return np.packbits(out, axis=-1, bitorder="little").reshape(len(raw), n, lane).view(f"<u{lane}")[..., 0].astype(np.uint32)


def encode_blocks(ids: np.ndarray, at_once: int = 512) -> tuple[bytes, np.ndarray]:
    """Ids below 2**32 as blocks, and the byte at which each block starts (the end included)."""
    pieces: list[bytes] = []
    for start in range(0, len(ids), BLOCK * at_once):
        some = ids[start : start + BLOCK * at_once].astype(np.uint32)
        whole = len(some) // BLOCK
        groups = [some[: whole * BLOCK].reshape(whole, BLOCK)] if whole else []
        if len(some) % BLOCK:
            groups.append(some[whole * BLOCK :].reshape(1, -1))
        for rows in groups:
            pieces.extend(_encode_rows(rows))
    return b"".join(pieces), np.cumsum([0] + [len(p) for p in pieces])


def _encode_rows(rows: np.ndarray) -> list[bytes]:
    n = rows.shape[1]
    least = rows.min(axis=1)
    rest = rows - least[:, None]
    rank = min(n - 1, -(-n * PERCENTILE // 100) - 1)
    widths = np.frexp(np.partition(rest, rank, axis=1)[:, rank].astype(np.float64))[1].astype(int)  # bits of a number
    out: list[bytes] = [b""] * len(rows)
    for width in np.unique(widths).tolist():
        at = np.flatnonzero(widths == width)
        body = rest[at]
        packed = _pack_rows(body & np.uint32((1 << width) - 1), width) if width else np.zeros((len(at), 0), np.uint8)
        high = body.astype(np.uint64) >> np.uint64(width)
        for k, row in enumerate(at.tolist()):
            places = np.flatnonzero(high[k])
            odd = np.empty(len(places), EXCEPTION)
            odd["place"], odd["high"] = places, high[k][places]
            head = np.array([(least[row], n, width, 0, len(places), 0)], HEADER)
            out[row] = head.tobytes() + packed[k].tobytes() + odd.tobytes()
    return out


def decode_blocks(payload: bytes, starts: np.ndarray) -> np.ndarray:
    """The ids of all blocks of a segment."""
    data = np.frombuffer(payload, np.uint8)
    begin = np.asarray(starts[:-1], np.int64)
    if not len(begin):
        return np.zeros(0, np.uint32)
    heads = data[begin[:, None] + np.arange(HEADER.itemsize)].copy().view(HEADER)[:, 0]
    sizes = heads["n"].astype(np.int64)
    to = np.cumsum(sizes)
    out = np.empty(int(to[-1]), np.uint32)
    kinds = sizes * 64 + heads["width"]
    for kind in np.unique(kinds).tolist():
        n, width = kind // 64, kind % 64
        for at in np.array_split(np.flatnonzero(kinds == kind), 1 + np.count_nonzero(kinds == kind) // 512):
            raw = data[begin[at][:, None] + HEADER.itemsize + np.arange((n * width + 7) // 8)]
            values = _unpack_rows(raw, width, n) if width else np.zeros((len(at), n), np.uint32)
            out[(to[at] - n)[:, None] + np.arange(n)] = values + heads["least"][at][:, None]
    for block in np.flatnonzero(heads["odd"]).tolist():
        n, width, count = int(sizes[block]), int(heads["width"][block]), int(heads["odd"][block])
        at = int(begin[block]) + HEADER.itemsize + (n * width + 7) // 8
        odd = np.frombuffer(payload, EXCEPTION, count, at)
        out[to[block] - n + odd["place"].astype(np.int64)] += odd["high"] << np.uint32(width)
    return out


def decode_block(payload: bytes, starts: np.ndarray, block: int) -> np.ndarray:
    """The ids of one block, read from its own bytes only."""
    a, b = int(starts[block]), int(starts[block + 1])
    return decode_blocks(payload[a:b], np.array([0, b - a]))


def _writer(path: str, end_id: int, special: bool):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = encoder(path, special)
        shard, segment = TaskContext.get().partitionId(), 0
        for batch in batches:
            for some in batches_of_bytes(batch, "text", SEGMENT_BYTES):
                ids, counts = tokenizer.encode(some.column("text"))
                ends = np.cumsum(counts)
                ids = np.insert(ids, ends, end_id)
                payload, starts = encode_blocks(ids)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([shard], pa.int32()),
                        pa.array([segment], pa.int32()),
                        pa.array([len(ids)], pa.int64()),
                        pa.array([starts.astype("<u4").tobytes()], pa.binary()),
                        pa.array([payload], pa.binary()),
                        pa.array([some.column("doc_id").to_pylist()], pa.list_(pa.int64())),
                        pa.array([(counts + 1).tolist()], pa.list_(pa.int64())),
                    ],
                    ["shard", "segment", "n_ids", "starts", "payload", "doc_ids", "doc_lengths"],
                )
                segment += 1

    return write


def write_token_files(docs: DataFrame, tokenizer_path: str, end_id: int, folder: str, special: bool = False) -> None:
    """Encode ``docs`` (doc_id, text) in ascending doc_id order into segment rows at ``folder``.

    Null ids come first; rows with equal ids are ordered by a hash of the text, and equal rows
    stand one after the other; a null text has the end id only; no rows give an empty table.
    ``special``: the spelling of a special token in a text is that token, as is the library's
    default; else it is plain text.
    """
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text").asc()]
    sorted_rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    sorted_rows.mapInArrow(_writer(tokenizer_path, end_id, special), SEGMENT_SCHEMA).write.parquet(folder)


def _reader(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in range(batch.num_rows):
            shard, segment, starts, payload, names, lengths = (batch.column(c)[row].as_py() for c in range(6))
            ids = decode_blocks(payload, np.frombuffer(starts, "<u4")).astype("<u4")
            to = np.cumsum(np.array(lengths, np.int64))
            begin = to - np.array(lengths, np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([shard] * len(names), pa.int32()),
                    pa.array([segment] * len(names), pa.int32()),
                    pa.array(names, pa.int64()),
                    pa.array(begin, pa.int64()),
                    pa.array(lengths, pa.int64()),
                    pa.array([zlib.crc32(ids[a:b].tobytes()) for a, b in zip(begin.tolist(), to.tolist())], pa.int64()),
                ],
                ["shard", "segment", "doc_id", "begin", "n_tokens", "ids_crc32"],
            )


def read_documents(spark: SparkSession, folder: str) -> DataFrame:
    """From the files: doc_id, start (ids before it in the whole sequence), n_tokens, ids_crc32."""
    files = spark.read.schema(SEGMENT_SCHEMA).parquet(folder)
    # one row per shard is summed up in one place, then the segments of each shard
    shards = files.groupBy("shard").agg(F.sum("n_ids").alias("ids"))
    earlier = W.orderBy("shard").rowsBetween(W.unboundedPreceding, -1)
    bases = shards.select("shard", F.coalesce(F.sum("ids").over(earlier), F.lit(0)).alias("base"))
    in_shard = W.partitionBy("shard").orderBy("segment").rowsBetween(W.unboundedPreceding, -1)
    segments = (
        files.select("shard", "segment", "n_ids")
        .join(bases, "shard")
        .select("shard", "segment", (F.col("base") + F.coalesce(F.sum("n_ids").over(in_shard), F.lit(0))).alias("first_id"))
    )
    read = files.select("shard", "segment", "starts", "payload", "doc_ids", "doc_lengths").mapInArrow(
        _reader, "shard int, segment int, doc_id long, begin long, n_tokens long, ids_crc32 long"
    )
    return read.join(segments, ["shard", "segment"]).select(
        "doc_id", (F.col("first_id") + F.col("begin")).alias("start"), "n_tokens", "ids_crc32"
    )
