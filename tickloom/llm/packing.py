"""Packing of token pieces into sequences by a grouping genetic algorithm on islands.

Pieces are dealt at random into blocks of some ``BLOCK_PIECES`` pieces. Each block has
``ISLANDS`` islands, tasks of their own, that evolve different populations of packings;
between epochs the best packings move on to the next island of the block. A chromosome is
the list of bins. Crossover takes whole well-filled bins of one parent into the other,
removes the bins there that hold the same pieces, and puts the displaced pieces where they
fit best. Bins that stay open in a block are packed again together with those of other
blocks, level by level, so that the loss at block borders goes away.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.taskcontext import TaskContext

from tickloom.llm.common import batches_of_bytes, materialise
from tickloom.llm.tokens import encoder, token_runs

CAPACITY = 1024
BLOCK_PIECES = 4096
ISLANDS = 3
EPOCHS = 2
GENERATIONS = 24
POPULATION = 6
ELITES = 2
LEVELS = 4
#: A bin this full counts as done.
DONE = 0.995


def best_fit(sizes: np.ndarray, order: np.ndarray, bins: np.ndarray, room: list[int], capacity: int) -> None:
    """Put the pieces of ``order`` one by one into the bin with least sufficient room, or a new one.

    ``bins`` (bin of each piece) and ``room`` (left in each bin) are changed in place.
    """
    with_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    mask = 0  # bit r: some bin has room r
    for number, left in enumerate(room):
        with_room[left].append(number)
        mask |= 1 << left
    for piece, size in zip(order.tolist(), sizes[order].tolist()):
        fitting = mask >> size
        if fitting:
            left = size + (fitting & -fitting).bit_length() - 1
            number = with_room[left].pop()
            if not with_room[left]:
                mask ^= 1 << left
            left -= size
        else:
            number, left = len(room), capacity - size
            room.append(left)
        room[number] = left
        bins[piece] = number
        with_room[left].append(number)
        mask |= 1 << left


def _renumbered(bins: np.ndarray) -> np.ndarray:
    return np.unique(bins, return_inverse=True)[1].astype(np.int32)


def fresh(sizes: np.ndarray, capacity: int, noise: float, rng: np.random.Generator) -> np.ndarray:
    """Best fit by falling size, the sizes shaken by ``noise``."""
    order = np.argsort(-sizes * (1 + noise * rng.standard_normal(len(sizes))), kind="stable")
    bins = np.zeros(len(sizes), np.int32)
    best_fit(sizes, order, bins, [], capacity)
    return bins


def fitness(bins: np.ndarray, sizes: np.ndarray, capacity: int) -> float:
    """Mean squared fill of the bins: fewer bins first of all, then full ones beside empty ones."""
    fill = np.bincount(bins, sizes) / capacity
    return float(np.mean(fill * fill))


def _inserted(bins: np.ndarray, gone: np.ndarray, loose: np.ndarray, sizes: np.ndarray, capacity: int) -> np.ndarray:
    """Bins without the pieces ``gone`` or ``loose``; loose pieces are put back by best fit."""
    out = bins.copy()
    stays = ~(gone | loose)
    out[stays] = _renumbered(bins[stays]) if stays.any() else 0
    room = (capacity - np.bincount(out[stays], sizes[stays])).astype(int).tolist() if stays.any() else []
    pieces = np.flatnonzero(loose)
    best_fit(sizes, pieces[np.argsort(-sizes[pieces], kind="stable")], out, room, capacity)
    return out


def crossover(giver: np.ndarray, taker: np.ndarray, sizes: np.ndarray, capacity: int, rng: np.random.Generator) -> np.ndarray:
    """Well-filled bins of ``giver`` go into ``taker``; what they displace is put back by best fit."""
    fill = np.bincount(giver, sizes)
    good = np.flatnonzero(fill >= np.quantile(fill, 0.5))
    chosen = np.zeros(len(fill), bool)
    chosen[rng.choice(good, max(1, len(good) // 3), replace=False)] = True
    injected = chosen[giver]
    hit = np.zeros(int(taker.max()) + 1, bool)
    hit[taker[injected]] = True
    displaced = hit[taker] & ~injected
    child = _inserted(taker, injected, displaced, sizes, capacity)
    base = int(child[~injected].max()) + 1 if not injected.all() else 0
    child[injected] = base + _renumbered(giver[injected])
    return child


def mutate(bins: np.ndarray, sizes: np.ndarray, capacity: int, rng: np.random.Generator) -> np.ndarray:
    """Break up the emptiest bins and a few others, and put their pieces back by best fit."""
    fill = np.bincount(bins, sizes)
    broken = np.zeros(len(fill), bool)
    broken[np.argsort(fill)[: max(1, len(fill) // 50)]] = True
    broken[rng.integers(0, len(fill), max(1, len(fill) // 50))] = True
    loose = broken[bins]
    return _inserted(bins, np.zeros(len(bins), bool), loose, sizes, capacity)


def evolve(sizes: np.ndarray, guests: list[np.ndarray], capacity: int, generations: int, rng: np.random.Generator) -> list[np.ndarray]:
    """Best packings of one island, best first. Ends early at the least possible number of bins."""
    least = -(-int(sizes.sum()) // capacity)
    people = [*guests]
    for k in range(POPULATION - len(people)):
        people.append(fresh(sizes, capacity, 0.0 if k == 0 else 0.05 * k, rng))
        if int(people[-1].max()) + 1 <= least:
            break
    marks = [fitness(p, sizes, capacity) for p in people]
    for _ in range(generations):
        ranked = sorted(range(len(people)), key=lambda i: -marks[i])
        people, marks = [people[i] for i in ranked[:POPULATION]], [marks[i] for i in ranked[:POPULATION]]
        if int(people[0].max()) + 1 <= least or len(people) < 2:
            break
        a, b = rng.choice(len(people), 2, replace=False).tolist()
        for child in (crossover(people[a], people[b], sizes, capacity, rng), mutate(people[a], sizes, capacity, rng)):
            people.append(_renumbered(child))
            marks.append(fitness(people[-1], sizes, capacity))
    ranked = sorted(range(len(people)), key=lambda i: -marks[i])
    return [people[i] for i in ranked[:ELITES]]


def _island(capacity: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                sizes = np.array(row["sizes"], np.int64)
                guests = [np.frombuffer(g, "<i4") for g in row["guests"]]
                rng = np.random.default_rng([seed, row["block"], row["island"]])
                best = evolve(sizes, guests, capacity, GENERATIONS, rng)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["block"]], pa.int64()),
                        pa.array([row["island"]], pa.int32()),
                        pa.array([row["keys"]], pa.list_(pa.int64())),
                        pa.array([row["sizes"]], pa.list_(pa.int32())),
                        pa.array([[p.astype("<i4").tobytes() for p in best]], pa.list_(pa.binary())),
                        pa.array([fitness(best[0], sizes, capacity)], pa.float64()),
                    ],
                    ["block", "island", "keys", "sizes", "guests", "mark"],
                )

    return run


ISLAND_SCHEMA = "block long, island int, keys array<long>, sizes array<int>, guests array<binary>, mark double"


def _placed(capacity: int):
    """Of each block's best packing, every piece's bin, place in the bin, and the bin's fill."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                sizes = np.array(row["sizes"], np.int64)
                bins = np.frombuffer(row["best"], "<i4").astype(np.int64)
                order = np.argsort(bins, kind="stable")
                before = np.cumsum(sizes[order]) - sizes[order]
                first = np.searchsorted(bins[order], bins[order])
                offset = np.empty(len(sizes), np.int64)
                offset[order] = before - before[first]
                fill = np.bincount(bins, sizes).astype(np.int64)[bins]
                columns = [np.array(row["keys"], np.int64), sizes.astype(np.int32), np.full(len(sizes), row["block"]), bins, offset, fill]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["key", "length", "block", "bin", "offset", "fill"])

    return place


def _evolved(pieces: DataFrame, n_blocks: int, capacity: int, level: int) -> DataFrame:
    spread = max(1, min(n_blocks * ISLANDS, 10_000))
    blocks = (
        pieces.withColumn("block", F.pmod(F.xxhash64("key", F.lit(level)), F.lit(n_blocks)))
        .groupBy("block")
        .agg(F.sort_array(F.collect_list(F.struct("key", "length"))).alias("held"))
        .select("block", F.col("held.key").alias("keys"), F.col("held.length").alias("sizes"))
    )
    islands = blocks.withColumn("island", F.explode(F.sequence(F.lit(0), F.lit(ISLANDS - 1)))).withColumn(
        "guests", F.array().cast("array<binary>")
    )
    columns = ["block", "island", "keys", "sizes", "guests"]
    for epoch in range(EPOCHS):
        ran = islands.select(*columns).repartition(spread, "block", "island").mapInArrow(_island(capacity, 100 * level + epoch), ISLAND_SCHEMA)
        if epoch < EPOCHS - 1:
            ring = W.partitionBy("block").orderBy("island")
            from_last = F.first("guests").over(ring.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
            islands = ran.withColumn("guests", F.coalesce(F.lead("guests").over(ring), from_last))
    best = ran.groupBy("block").agg(F.max_by(F.struct("keys", "sizes", F.col("guests")[0].alias("best")), F.struct("mark", "island")).alias("top"))
    return best.select("block", "top.*").mapInArrow(_placed(capacity), "key long, length int, block long, bin long, offset long, fill long")


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Put pieces (key, length) into sequences of ``capacity``: (key, sequence_id, offset).

    Every key is one piece; lengths are 1 to ``capacity``. Pieces of the full length get
    sequences of their own. Sequence ids are unique numbers without an order.
    """
    full = pieces.where(F.col("length") == capacity).select("key", (-F.col("key") - 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    rest, done = pieces.where(F.col("length") < capacity).select("key", "length"), full
    for level in range(LEVELS):
        left = rest.count()
        if left == 0:
            break
        n_blocks = -(-left // BLOCK_PIECES)
        placed = materialise(_evolved(rest, n_blocks, capacity, level), f"packed-{level}")
        last = level == LEVELS - 1 or n_blocks == 1
        closed = F.lit(True) if last else F.col("fill") >= int(DONE * capacity)
        number = (F.lit(level).cast("long") * (1 << 58)) + F.col("block") * (1 << 20) + F.col("bin")
        done = done.unionByName(placed.where(closed).select("key", number.alias("sequence_id"), "offset"))
        if last:
            break
        rest = placed.where(~closed).select("key", "length")
    return done


def _cutter(path: str, end_id: int, capacity: int, with_ids: bool, special: bool):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = encoder(path, special)
        key = TaskContext.get().partitionId() << 40
        for batch in batches:
            for some in batches_of_bytes(batch, "text", 4_000_000):
                ids, counts = tokenizer.encode(some.column("text"))
                rows: list[tuple] = []
                for name, run in zip(some.column("doc_id").to_pylist(), token_runs(ids, counts, end_id)):
                    first = (len(run) - 1) % capacity + 1  # the first piece may be shorter
                    edges = [0, *range(first, len(run) + 1, capacity)]
                    for number, (a, b) in enumerate(zip(edges[:-1], edges[1:])):
                        rows.append((key, name, number, a, b - a, zlib.crc32(run[a:b].tobytes()), run[a:b] if with_ids else None))
                        key += 1
                columns = list(zip(*rows))
                kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
                arrays = [pa.array(c, k) for c, k in zip(columns, kinds)]
                names = ["key", "doc_id", "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    arrays.append(pa.array([x.astype(np.int32) for x in columns[6]], pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(arrays, names)

    return cut


def token_pieces(
    docs: DataFrame, tokenizer_path: str, end_id: int, capacity: int = CAPACITY, with_ids: bool = False, special: bool = False
) -> DataFrame:
    """Pieces of every row of ``docs`` (doc_id, text): key, doc_id, piece, start, length, ids_crc32[, ids].

    A document's ids and the end id, cut into pieces of ``capacity`` if longer, of which the
    first may be shorter. Keys are unique numbers of the run. ``special``: the spelling of a special
    token in a text is that token, as is the library's default; else it is plain text.
    """
    schema = "key long, doc_id long, piece int, start long, length long, ids_crc32 long" + (", ids array<int>" if with_ids else "")
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return texts.mapInArrow(_cutter(tokenizer_path, end_id, capacity, with_ids, special), schema)


def pack_documents(
    docs: DataFrame, tokenizer_path: str, end_id: int, capacity: int = CAPACITY, with_ids: bool = False, special: bool = False
) -> DataFrame:
    """``token_pieces`` of all documents with sequence_id and offset.

    Null and empty texts are the end id alone; rows with equal or null ids are packed as
    documents of their own; no rows give no rows; other columns are ignored. Texts and ids
    are not shuffled: only keys and lengths are, to be packed.
    """
    pieces = materialise(token_pieces(docs, tokenizer_path, end_id, capacity, with_ids, special), "pieces")
    places = pack(pieces.select("key", F.col("length").cast("int").alias("length")), capacity)
    return pieces.join(places, "key").drop("key")
