"""Hard negatives by rotated one-bit codes with deterministic score intervals.

Index: a vector's direction is rotated, and its signs are its code. Stored beside the code is
its alignment: the inner product of the direction and the code as a unit vector. What the code
leaves over is at a right angle to it; its direction is coded again under another rotation,
``LEVELS`` times, and the length of the last rest is stored. Every vector is indexed.

Search: an anchor is rotated and rounded to ``QUERY_BITS`` bits a component. Popcounts of its bit
planes with the codes give the anchor's inner products with the codes; with the alignments they
give an estimate of the score, off by at most the rounding's error and, by Cauchy and Schwarz,
the length of the rest times that of the anchor's part at a right angle to the last code. Only
vectors whose interval can still reach an anchor's list are scored, in integers; so lists are exact.

Anchors go out in blocks of bounded size, each over all vectors where they are read; a task keeps
for each anchor its best rows only, and these meet in one top-k per anchor.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tickloom.llm.common import materialise, per_worker
from tickloom.llm.vectors import dimensions, is_finite, lists, matrix, rotation
from tickloom.session import run_dir

LEVELS = 4
QUERY_BITS = 6
#: Bytes of anchors' vectors that are broadcast at once.
ANCHOR_BYTES = 8_000_000
#: Vectors that a task compares with an anchor at once.
ROWS = 16_384
POSITIVES = 5
NEGATIVES = 10

INDEX = "vec_id long, label long, vector array<long>, codes binary, shares array<double>, rest double, norm double"
POSITIVE = "anchor long, row long, vec_id long, score long"
NEGATIVE = "anchor long, place int, row long, vec_id long, score long"


def rotations(dims: int) -> list[np.ndarray]:
    return per_worker(("rotations", dims), lambda: [rotation(dims, 11 + level) for level in range(LEVELS)])


def encode(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Codes (n, levels, words of 64 bits), what each code counts for, the last rest's length, the norms.

    A vector of norm 1 is the sum of its codes, as unit vectors turned back, times their
    shares, and a rest at a right angle to the last code. A zero vector has shares of 0.
    """
    n, dims = vectors.shape
    norm = np.sqrt((vectors**2).sum(axis=1))
    left = vectors / np.where(norm > 0, norm, 1)[:, None]
    codes = np.zeros((n, LEVELS, dims // 64), np.uint64)
    shares = np.zeros((n, LEVELS))
    for level, turn in enumerate(rotations(dims)):
        turned = left @ turn
        signs = np.where(turned >= 0, 1.0, -1.0) / np.sqrt(dims)
        codes[:, level] = np.packbits(turned >= 0, axis=1, bitorder="little").view(np.uint64)
        shares[:, level] = (turned * signs).sum(axis=1)
        left = (turned - shares[:, level, None] * signs) @ turn.T
    return codes, shares, np.sqrt((left**2).sum(axis=1)), norm


class Query:
    """An anchor, rounded to bits in every level's rotation."""

    def __init__(self, vector: np.ndarray) -> None:
        self.norm = float(np.sqrt((vector**2).sum()))
        self.levels = []
        root = np.sqrt(len(vector))
        for turn in rotations(len(vector)):
            turned = vector @ turn
            low = turned.min()
            step = (turned.max() - low) / (2**QUERY_BITS - 1) or 1.0
            whole = np.rint((turned - low) / step).astype(np.uint64)
            bits = ((whole[None, :] >> np.arange(QUERY_BITS, dtype=np.uint64)[:, None]) & np.uint64(1)).astype(np.uint8)
            planes = np.packbits(bits, axis=1, bitorder="little").view(np.uint64)
            error = np.abs(turned - (low + step * whole.astype(float))).sum() / root
            self.levels.append((planes, low / root, step / root, int(whole.sum()), error))

    def interval(self, codes: np.ndarray, shares: np.ndarray, rest: np.ndarray, norm: np.ndarray, ones: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper bounds of the scores of vectors; ``ones`` are the bits set in each code."""
        dims = codes.shape[2] * 64
        estimate, off = np.zeros(len(codes)), np.zeros(len(codes))
        for level, (planes, low, step, total, error) in enumerate(self.levels):
            counted = np.zeros(len(codes), np.int64)
            for bit, plane in enumerate(planes):
                both = np.bitwise_count(codes[:, level] & plane)
                counted += (both[:, 0] if both.shape[1] == 1 else both.sum(axis=1, dtype=np.int64)).astype(np.int64) << bit
            # a sum over components of the sign times (low + step * whole)
            with_code = low * (2 * ones[:, level] - dims) + step * (2 * counted - total)
            estimate += shares[:, level] * with_code
            off += np.abs(shares[:, level]) * error
        nearest = np.maximum(np.abs(with_code) - error, 0)
        off += rest * np.sqrt(np.maximum(self.norm**2 - nearest**2, 0)) + 1e-9 * self.norm
        return (estimate - off) * norm - 1e-6, (estimate + off) * norm + 1e-6


def integer_scores(vectors: np.ndarray, vector: np.ndarray) -> np.ndarray:
    """Exact inner products; doubles where they hold them exactly."""
    most = float(np.abs(vectors).max(initial=0)) * float(np.abs(vector).max(initial=0)) * len(vector)
    if most < 2.0**53:
        return (vectors.astype(float) @ vector.astype(float)).astype(np.int64)
    if most < 2.0**62:
        return vectors @ vector
    return np.array([sum(int(a) * int(b) for a, b in zip(v, vector)) for v in vectors], np.int64)


def _best(scores: np.ndarray, ids: np.ndarray, rows: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The first ``most`` by score, highest first, then id."""
    order = np.lexsort((rows, ids, -scores))[:most]
    return scores[order], ids[order], rows[order]


class Block:
    """Some rows of the index, as arrays."""

    def __init__(self, batch: pa.RecordBatch, dims: int) -> None:
        self.row, self.vec_id, self.label = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("row", "vec_id", "label"))
        self.vectors = matrix(batch.column("vector"), dims)
        codes = np.frombuffer(b"".join(batch.column("codes").to_pylist()), np.uint64)
        self.codes = codes.reshape(batch.num_rows, LEVELS, dims // 64)
        self.ones = np.bitwise_count(self.codes).sum(axis=2, dtype=np.int64)
        self.shares = matrix(batch.column("shares"), LEVELS)
        self.rest, self.norm = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("rest", "norm"))

    def interval(self, query: Query) -> tuple[np.ndarray, np.ndarray]:
        return query.interval(self.codes, self.shares, self.rest, self.norm, self.ones)


def _blocks(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[Block]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            yield Block(batch.slice(at, ROWS), dims)


def _kth(values: np.ndarray, k: int) -> float:
    """The k-th largest, minus infinity if there are fewer."""
    return float(np.partition(values, len(values) - k)[len(values) - k]) if len(values) >= k else -np.inf


NOTHING = (np.zeros(0, np.int64),) * 3


def _search(anchors, dims: int, windows: bool):
    """Over index rows, each anchor's best: same label; or, for each of its windows, another label and a score in it."""

    def lists_of(anchor, block: Block, query: Query, held: list) -> None:
        row, label, vector, bounds = anchor
        low, high = block.interval(query)
        takes_part = block.label != label if windows else (block.label == label) & (block.row != row)
        most = NEGATIVES if windows else POSITIVES
        wanted = np.zeros(len(low), bool)
        for (least, top), best in zip(bounds, held):
            sure = takes_part & (low >= least) & (high <= top)
            reached = max(least, _kth(low[sure], most), best[0][-1] if len(best[0]) == most else -np.inf)
            wanted |= takes_part & (high >= reached) & (low <= top)
        at = np.flatnonzero(wanted)
        if not len(at):
            return
        scores = integer_scores(block.vectors[at], vector)
        for place, (least, top) in enumerate(bounds):
            fits = (scores >= least) & (scores <= top)
            there = at[fits]
            new = (scores[fits], block.vec_id[there], block.row[there])
            held[place] = _best(*(np.concatenate(x) for x in zip(held[place], new)), most)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = None
        for block in _blocks(batches, dims):
            if queries is None:
                given = anchors.value
                queries = [Query(vector.astype(float)) for _, _, vector, _ in given]
                held = [[NOTHING] * len(bounds) for *_, bounds in given]
            for anchor, query, lists_held in zip(given, queries, held):
                lists_of(anchor, block, query, lists_held)
        if queries is None:
            return
        for anchor, lists_held in zip(given, held):
            for place, (scores, ids, rows) in enumerate(lists_held):
                if len(scores):
                    same = np.full(len(scores), anchor[0])
                    columns = [same, np.full(len(scores), place, np.int32), rows, ids, scores]
                    names = ["anchor", "place", "row", "vec_id", "score"]
                    if not windows:
                        del columns[1], names[1]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)

    return search


def build_index(vectors: DataFrame) -> tuple[DataFrame, int]:
    """A written table with a row for every vector that takes part, and the number of components coded.

    ``vectors`` has vec_id, label and embedding. Components become floor(256 * x). ``row`` numbers
    the rows. Rows without an id, a label, or with a null or non-finite component take no part.
    """
    vector = F.col("embedding").cast("array<double>").alias("vector")
    given = vectors.select(F.col("vec_id").cast("long"), F.col("label").cast("long"), vector)
    given = given.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & is_finite(F.col("vector")))
    dims = max(64, -(-dimensions(given, "vector") // 64) * 64)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                some = batch.slice(at, ROWS)
                whole = np.floor(256 * matrix(some.column("vector"), dims)).astype(np.int64)
                codes, shares, rest, norm = encode(whole.astype(float))
                yield pa.RecordBatch.from_arrays(
                    [some.column("vec_id"), some.column("label"), lists(whole), pa.array([c.tobytes() for c in codes], pa.binary()), lists(shares), pa.array(rest), pa.array(norm)],
                    ["vec_id", "label", "vector", "codes", "shares", "rest", "norm"],
                )

    numbered = given.mapInArrow(code, INDEX).withColumn("row", F.monotonically_increasing_id())
    return materialise(numbered, "hard-negative-index"), dims


def _anchor_blocks(index: DataFrame, every: int, dims: int) -> Iterator[list[tuple]]:
    """Anchors (row, vec_id, label, vector) in lists of bounded size."""
    most = max(1, ANCHOR_BYTES // (8 * dims))
    block: list[tuple] = []
    for r in index.where(F.col("vec_id") % every == 0).select("row", "vec_id", "label", "vector").toLocalIterator():
        block.append((r["row"], r["vec_id"], r["label"], np.array(r["vector"], np.int64)))
        if len(block) == most:
            yield block
            block = []
    if block:
        yield block


def _top(found: DataFrame, keys: list[str], most: int) -> DataFrame:
    order = W.partitionBy(*keys).orderBy(F.col("score").desc(), "vec_id", "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


def mine_hard_negatives(vectors: DataFrame, every: int = 100, least_share: int = 30, most_share: int = 90) -> DataFrame:
    """Negatives of each anchor and positive: anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``vectors`` has vec_id, label and embedding. Scores are inner products of the integer
    vectors. Anchors are rows whose id is divisible by ``every``; an anchor's positives are its
    first ``POSITIVES`` other rows of the same label, highest score first, smaller id on a tie.
    Negatives are the first ``NEGATIVES`` rows of other labels with a score between
    ``least_share`` and ``most_share`` percent of the positive's. Fewer if there are no more.

    Rows without an id, a label or a vector, or with a null or non-finite component, take no part;
    shorter vectors count as ending in zeros; rows that repeat are rows of their own, so a repeated
    anchor mines twice and is its own copy's positive; no rows give no rows; other columns are
    ignored. Scores beyond 64 bits are an error.
    """
    spark = vectors.sparkSession
    index, dims = build_index(vectors)
    folder = run_dir(spark, "hard-negatives")
    columns = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    spark.createDataFrame([], columns).write.parquet(folder)
    everything = (np.iinfo(np.int64).min, np.iinfo(np.int64).max)
    for block in _anchor_blocks(index, every, dims):
        sent = spark.sparkContext.broadcast([(row, label, vector, [everything]) for row, _, label, vector in block])
        near = index.mapInArrow(_search(sent, dims, False), POSITIVE)
        positives: dict[int, list[tuple[int, int]]] = {}
        for r in _top(near, ["anchor"], POSITIVES).orderBy("anchor", "rank").collect():  # POSITIVES rows for each anchor of the block
            positives.setdefault(r["anchor"], []).append((r["vec_id"], r["score"]))
        bounds = {a: [(-(-least_share * s // 100), most_share * s // 100) for _, s in held] for a, held in positives.items()}
        asked = [(row, label, vector, bounds[row]) for row, _, label, vector in block if row in bounds]
        sent_windows = spark.sparkContext.broadcast(asked)
        far = index.mapInArrow(_search(sent_windows, dims, True), NEGATIVE)
        names = [(row, place, vec_id, *positive) for row, vec_id, _, _ in block for place, positive in enumerate(positives.get(row, []))]
        named = spark.createDataFrame(names, "anchor long, place int, anchor_id long, positive_id long, positive_score long")
        chosen = _top(far, ["anchor", "place"], NEGATIVES).join(named, ["anchor", "place"])
        chosen.select(
            "anchor_id", "positive_id", F.col("rank").cast("int"), F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
        ).write.mode("append").parquet(folder)
        sent.unpersist()
        sent_windows.unpersist()
    return spark.read.schema(columns).parquet(folder)


def relabelled(vectors: DataFrame) -> DataFrame:
    """``vectors`` whose ids divisible by 7 have the next of ten labels."""
    label = F.col("label").cast("long")
    return vectors.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label))


HARD_NEGATIVE_SQL = """
WITH given AS (
    SELECT row_number() OVER () AS row, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT a.row AS anchor, a.vec_id AS anchor_id, b.row, b.vec_id, a.label = b.label AS same, list_inner_product(a.v, b.v)::BIGINT AS score
    FROM given AS a JOIN given AS b ON a.row <> b.row WHERE a.vec_id % 100 = 0
), positives AS (
    SELECT anchor, anchor_id, row AS positive, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id) <= 5
), ranked AS (
    SELECT p.anchor_id, p.positive_id, row_number() OVER (PARTITION BY p.anchor, p.positive ORDER BY s.score DESC, s.vec_id) AS rank,
        s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
    FROM positives AS p JOIN scored AS s ON s.anchor = p.anchor
    WHERE NOT s.same AND 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score
)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= 10
"""
