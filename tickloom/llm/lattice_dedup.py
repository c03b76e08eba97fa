"""Near duplicates of embeddings by E8 lattice hashing.

Each of ``TABLES`` tables projects a vector's direction on eight random directions and decodes
the point to the nearest point of the E8 lattice: its home cell. It also probes the neighbouring
cells, those of the lattice's 240 shortest vectors nearest to the point. Two vectors meet if
they share a home or one probes the other's home. All that meet are compared by cosine, in
double precision, so no pair below the threshold is a link.

At a cosine of 0.9 two vectors meet in one table with a probability of 0.42, in one of seven
with 0.98; unlike vectors meet in a table with 0.003 (tests measure recall). Equal vectors are
one node with a count. A cell's members are compared in slices of bounded size, every two slices in
a task of their own, so that no cell, however many near copies it holds, is one task. A task
returns the number of links of each member and a forest of its links, never pairs. A pair that
meets several times counts only at its first meeting, which both rows' cells tell.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import materialise, per_worker
from tickloom.llm.near_dedup import components
from tickloom.llm.vectors import dimensions, is_finite, lists, matrix
from tickloom.llm.words import mix

COSINE = 0.9
TABLES = 7
PROBES = 2
#: Edge of the projections' unit of length; a larger one makes cells that hold more.
WIDTH = 1.5
#: Members of a cell that are compared with as many others in one task.
SLICE = 2_000

CELLS = "node long, copies long, vector array<double>, homes array<long>, probes array<long>"
FOUND = "a long, b long, n long"


def e8_roots() -> np.ndarray:
    """The 240 shortest vectors of the lattice."""
    whole = [tuple(s if k == i else t if k == j else 0.0 for k in range(8)) for i, j in itertools.combinations(range(8), 2) for s in (1.0, -1.0) for t in (1.0, -1.0)]
    half = [signs for signs in itertools.product((0.5, -0.5), repeat=8) if sum(x < 0 for x in signs) % 2 == 0]
    return np.array(whole + half)


def _even(points: np.ndarray) -> np.ndarray:
    """Nearest integer points with an even sum."""
    near = np.rint(points)
    odd = np.flatnonzero(near.sum(axis=1) % 2)
    off = points[odd] - near[odd]
    worst = np.abs(off).argmax(axis=1)
    near[odd, worst] += np.where(off[np.arange(len(odd)), worst] >= 0, 1.0, -1.0)
    return near


def decode_e8(points: np.ndarray) -> np.ndarray:
    """Nearest lattice points: of the integer points with an even sum and those moved by a half."""
    a, b = _even(points), _even(points - 0.5) + 0.5
    return np.where((((points - a) ** 2).sum(axis=1) <= ((points - b) ** 2).sum(axis=1))[:, None], a, b)


def _cell_names(lattice: np.ndarray, table: int) -> np.ndarray:
    """A 64-bit name of each lattice point (its last axis) in a table."""
    name = np.full(lattice.shape[:-1], mix(np.array([table + 1], np.uint64))[0])
    for k in range(8):
        name = mix(name ^ (2 * lattice[..., k]).astype(np.int64).view(np.uint64))
    return name.view(np.int64)


def projections(dims: int, tables: int) -> np.ndarray:
    return np.random.default_rng(8).standard_normal((tables, dims, 8))


def cells(units: np.ndarray, tables: int = TABLES, probes: int = PROBES, width: float = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """Home cells (n, tables) and probed cells (n, tables * probes) of unit vectors."""
    roots = per_worker("e8-roots", e8_roots)
    turns = per_worker(("e8-projections", units.shape[1], tables), lambda: projections(units.shape[1], tables))
    homes, probed = [], []
    for table in range(tables):
        points = units @ turns[table] / width
        home = decode_e8(points)
        nearest = np.argsort(-((points - home) @ roots.T), axis=1, kind="stable")[:, :probes]
        homes.append(_cell_names(home, table)[:, None])
        probed.append(_cell_names(home[:, None, :] + roots[nearest], table))
    return np.concatenate(homes, axis=1), np.concatenate(probed, axis=1)


def _locate(dims: int):
    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = matrix(batch.column("vector"), dims)
            largest = np.abs(vectors).max(axis=1, initial=0)
            scaled = vectors / largest[:, None]  # squares neither overflow nor vanish
            units = scaled / np.sqrt((scaled**2).sum(axis=1))[:, None]
            homes, probed = cells(units)
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), batch.column("copies"), lists(units), lists(homes), lists(probed)], ["node", "copies", "vector", "homes", "probes"]
            )

    return locate


class Members:
    """Rows of one cell."""

    def __init__(self, batch: pa.RecordBatch, dims: int) -> None:
        self.node, self.copies = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("node", "copies"))
        self.role = batch.column("role").to_numpy(zero_copy_only=False)
        self.units = matrix(batch.column("vector"), dims)
        self.cell, i, j = (batch.column(c)[0].as_py() for c in ("cell", "i", "j"))
        #: in other groups, pairs within the left slice are compared elsewhere
        self.diagonal = i == j
        self.homes, self.probes = matrix(batch.column("homes"), TABLES), matrix(batch.column("probes"), TABLES * PROBES)

    def probed(self, at: np.ndarray, other: np.ndarray, table: int) -> np.ndarray:
        """Which of ``at`` probe the home of ``other`` in a table?"""
        own = self.probes[at, table * PROBES : (table + 1) * PROBES]
        return (own == self.homes[other, table, None]).any(axis=1)


#: A slice of the cell's homes, another slice of them, and those that probe the cell.
LEFT, RIGHT, PROBING = 0, 1, 2


def _first_meetings(m: Members, a: np.ndarray, b: np.ndarray, table: int, probing: bool) -> np.ndarray:
    """Is this cell of ``table`` where the pairs (a, b) meet first? If ``probing``, b probes the home of a."""
    first = np.ones(len(a), bool)
    for t in range(table):
        first &= ~((m.homes[a, t] == m.homes[b, t]) | m.probed(a, b, t) | m.probed(b, a, t))
    if probing:  # if each probes the other's home, the smaller node's home counts
        first &= ~(m.probed(a, b, table) & (m.node[b] < m.node[a]))
    return first


def _forest(a: np.ndarray, b: np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges that connect what the edges (a, b), as places in ``nodes``, connect: fewer than there are nodes."""
    name = np.arange(len(nodes))
    while True:
        least = name.copy()
        np.minimum.at(least, a, name[b])
        np.minimum.at(least, b, name[a])
        least = least[least]
        if (least == name).all():
            break
        name = least
    moved = np.flatnonzero(name != np.arange(len(nodes)))
    return nodes[moved], nodes[name[moved]]


def _compare_cell(m: Members, least: float) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Forest edges (a, b, 0) and counts (a, -1, links) of a cell's pairs."""
    left = np.flatnonzero(m.role == LEFT)
    found = []
    for role in (LEFT, RIGHT, PROBING):
        right = np.flatnonzero(m.role == role)
        if not len(left) or not len(right) or (role == LEFT and not m.diagonal):
            continue
        for at in range(0, len(right), SLICE):
            some = right[at : at + SLICE]
            x, y = np.nonzero(m.units[left] @ m.units[some].T >= least)
            a, b = left[x], some[y]
            keep = a < b if role == LEFT else m.node[a] != m.node[b]
            found.append((a[keep], b[keep], role))
    a, b = (np.concatenate([f[k] for f in found]) if found else np.zeros(0, int) for k in (0, 1))
    if not len(a):
        return []
    from_node, to_node = _forest(a, b, m.node)
    out = [(from_node, to_node, np.zeros(len(from_node), np.int64))]
    table = int(np.flatnonzero((m.homes[left[:1]] == m.cell)[0])[0])
    counts = np.zeros(len(m.node), np.int64)
    for a, b, role in found:
        first = _first_meetings(m, a, b, table, role == PROBING)
        np.add.at(counts, a[first], m.copies[b[first]])
        np.add.at(counts, b[first], m.copies[a[first]])
    some = np.flatnonzero(counts)
    return [*out, (m.node[some], np.full(len(some), -1), counts[some])]


def _compare(least: float, dims: int):
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def groups() -> Iterator[pa.RecordBatch]:
            held: list[pa.RecordBatch] = []
            of = None
            for batch in batches:
                keys = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in ("cell", "i", "j")], axis=1)
                ends = [*(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), len(keys)] if len(keys) else []
                at = 0
                for end in ends:
                    if of != (of := tuple(keys[at].tolist())) and held:
                        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                        held = []
                    held.append(batch.slice(at, end - at))
                    at = end
            if held:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]

        for group in groups():
            for columns in _compare_cell(Members(group, dims), least):
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["a", "b", "n"])

    return compare


def _met(located: DataFrame) -> DataFrame:
    """Rows of all cells with something to compare, by (cell, i, j): a slice i of the homes with a slice j of homes and probing rows."""
    homes = located.select(F.explode("homes").alias("cell"), "node", F.lit(True).alias("home"))
    probes = located.select(F.explode("probes").alias("cell"), "node", F.lit(False).alias("home"))
    both = homes.unionByName(probes)
    sizes = both.groupBy("cell").agg(F.count(F.when(F.col("home"), 1)).alias("n_homes"), F.count("*").alias("n")).where("n_homes > 0 AND n > 1")
    slices = lambda n: F.greatest(F.ceil(n / SLICE), F.lit(1)).cast("int")
    sizes = materialise(sizes.select("cell", slices(F.col("n_homes")).alias("sh"), slices(F.col("n") - F.col("n_homes")).alias("sp")), "cells")
    sized = both.join(sizes, "cell")
    own = lambda n: F.pmod(F.xxhash64("node"), n).cast("int")
    entry = lambda i, j, role: F.struct(i.alias("i"), j.alias("j"), F.lit(role).alias("role"))
    wide = F.sequence(F.lit(0), F.greatest("sh", "sp") - 1)
    as_left = F.transform(F.filter(wide, lambda j: (j < F.col("sp")) | ((j >= F.col("at")) & (j < F.col("sh")))), lambda j: entry(F.col("at"), j, LEFT))
    as_right = F.transform(F.filter(wide, lambda i: i < F.col("at")), lambda i: entry(i, F.col("at"), RIGHT))
    of_home = sized.where("home").withColumn("at", own(F.col("sh"))).select("cell", "node", F.explode(F.concat(as_left, as_right)).alias("e"))
    of_probe = sized.where("NOT home").withColumn("at", own(F.col("sp")))
    of_probe = of_probe.select("cell", "node", F.explode(F.transform(F.sequence(F.lit(0), F.col("sh") - 1), lambda i: entry(i, F.col("at"), PROBING))).alias("e"))
    return of_home.unionByName(of_probe).select("cell", "e.*", "node").join(located, "node")


def near_vectors(vectors: DataFrame, least: float = COSINE) -> DataFrame:
    """Links of every row of ``vectors`` (vec_id, embedding): vec_id, n_links, component_id, kept.

    ``n_links`` counts the other rows with a cosine of ``least`` or more that are found;
    ``component_id`` is the smallest id that links reach, the row's own included, null if none
    of them has an id; ``kept`` tells whether it is the row's own id. Vectors that are null,
    zero, or hold null or non-finite components link with nothing. Shorter vectors count as
    ending in zeros. Rows with equal vectors link, whatever their ids; of rows that share the
    smallest id of their component each is kept. No rows give no rows. Other columns are ignored.
    """
    given = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>").alias("vector"))
    usable = is_finite(F.col("vector")) & F.exists("vector", lambda x: x != 0)
    rows = given.withColumn("vector", F.when(usable, F.col("vector")))
    some = rows.where(F.col("vector").isNotNull())
    dims = dimensions(some, "vector")
    full = F.concat(F.col("vector"), F.array_repeat(F.lit(0.0), F.lit(dims) - F.size("vector")))
    some = some.withColumn("vector", full)
    nodes = some.groupBy("vector").agg(F.min("vec_id").alias("first_id"), F.count("*").alias("copies"))
    nodes = materialise(nodes.withColumn("node", F.monotonically_increasing_id()), "vectors")
    located = materialise(nodes.select("node", "copies", "vector").mapInArrow(_locate(dims), CELLS), "located")
    in_order = _met(located).repartition("cell", "i", "j").sortWithinPartitions("cell", "i", "j", "role")
    found = materialise(in_order.mapInArrow(_compare(least, dims), FOUND), "found")
    counts = found.where("b = -1").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("n"))
    parts = components(found.where("b <> -1").select("a", "b"))
    judged = nodes.join(counts, "node", "left").join(parts, "node", "left").withColumn("component", F.coalesce("component", "node"))
    judged = materialise(judged.select("vector", "first_id", "component", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links")), "judged")
    smallest = judged.groupBy("component").agg(F.min("first_id").alias("component_id"))
    judged = judged.join(smallest, "component").select("vector", "n_links", "component_id")
    linked = some.join(judged, "vector").select("vec_id", "n_links", "component_id")
    alone = rows.where(F.col("vector").isNull()).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
