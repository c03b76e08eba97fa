"""Near duplicates by DartMinHash signatures of weighted shingle sets.

A document is the multiset of its five-word shingles. The c-th occurrence of a shingle is a
region of weight one at which hashed darts are thrown: a Poisson process of ranks drawn from
the hash of (shingle, c), the same in every document. Some ``k ln k + 2k`` darts per document
land below its rank limit, each in a coordinate its hash names; each coordinate keeps its
earliest dart. Two documents agree in a coordinate with a probability equal to the weighted
Jaccard similarity of their multisets. Coordinates no dart has reached are filled by raising
the limit. Bands of coordinates are buckets.

Links are found in rounds. The hub of a bucket is its member with the largest buckets. Every
member is compared with the first hub of its buckets, then with each of its buckets' hubs not in
its component: a text with many copies is the hub of its buckets, whatever its id. A pair is
compared once however many buckets it shares, and not at all if its texts' lengths rule the
similarity out. Buckets that still hold several components are cut into cells, a slice of the members
outside the largest component against a slice of all members. A cell is compared at once, as a product
of the 0/1 matrices of its texts' regions, which is exact, and lets go links that join its
components, one less than there are, never a row for each pair. So rows and shuffled bytes follow
the members of the buckets times their slices, and only the products follow the pairs.

Comparisons are spread by bytes and rows, so no group is ever in one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import batches_of_bytes, materialise
from tickloom.llm.words import LOWER, NOT_ALPHANUMERIC, Words, find_words, mix, text_bytes, whole_windows, window_hashes

SHINGLE = 5
SIMILARITY = 0.8
BANDS = 26
ROWS = 5
COORDINATES = BANDS * ROWS
DARTS = COORDINATES * (np.log(COORDINATES) + 2)
#: Class numbers of rows without words start here; numbers of texts lie below.
ALONE = 1 << 62
#: Text and number of members that one task compares with a leader.
VERIFY_BYTES = 1_000_000
VERIFY_ROWS = 200
#: Members and bytes of text in a slice of a bucket, and the regions multiplied at once.
SLICE_ROWS = 1_000
SLICE_BYTES = 8_000_000
REGIONS_AT_ONCE = 4_096
#: Candidates whose node numbers (8 bytes each) are broadcast to where the texts are read, so that
#: other texts stay there; with more candidates all texts are shuffled once. The result is the same.
BROADCAST_CANDIDATES = 4_000_000

SIGNATURE_SCHEMA = "doc_id long, text_key long, fp1 long, fp2 long, n_bytes long, n_shingles long, bands array<long>"


def normal_words(column: pa.Array) -> Words:
    """Lower-case words of letters, digits and whatever lies beyond ASCII."""
    data, offsets = text_bytes(column)
    return find_words(LOWER[data], offsets, NOT_ALPHANUMERIC)


def shingles(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles and the text of each; a text of fewer words is one shingle."""
    at = np.flatnonzero(whole_windows(words.first, SHINGLE))
    hashes, texts = window_hashes(words.hash, SHINGLE)[at], words.text[at]
    n = np.diff(words.first)
    short = np.flatnonzero((n > 0) & (n < SHINGLE))
    if len(short):
        whole = np.array([mix(window_hashes(words.hash[words.first[i] : words.first[i + 1]], int(n[i])) + np.uint64(n[i]))[0] for i in short.tolist()])
        hashes, texts = np.concatenate([hashes, whole]), np.concatenate([texts, short])
    return hashes, texts


def regions(hashes: np.ndarray, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unit regions: the c-th occurrence of a shingle in a text has a hash of its own."""
    order = np.lexsort((hashes, texts))
    hashes, texts = hashes[order], texts[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (texts[1:] != texts[:-1])
    begin = np.flatnonzero(new)
    occurrence = np.arange(len(hashes)) - np.repeat(begin, np.diff(np.append(begin, len(hashes))))
    return mix(hashes + mix(occurrence.astype(np.uint64) + np.uint64(1))), texts


def dart_signatures(units: np.ndarray, texts: np.ndarray, n: int, k: int = COORDINATES, darts: float = DARTS) -> np.ndarray:
    """The earliest dart of each of ``k`` coordinates, for ``n`` texts; 0 where a text has no region."""
    signature = np.zeros(n * k, np.uint64)
    weight = np.bincount(texts, minlength=n)
    limit = darts / np.maximum(weight, 1)
    open_texts = weight > 0
    while open_texts.any():
        here = np.flatnonzero(open_texts[texts])
        rank = np.zeros(len(units))
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        throw = np.uint64(0)
        while len(here):
            throw += np.uint64(1)
            dart = mix(units[here] ^ mix(np.array([throw], np.uint64)))
            rank[here] -= np.log(((dart >> np.uint64(11)).astype(np.float64) + 1) / 2.0**53)
            below = rank[here] <= limit[texts[here]]
            here, dart = here[below], dart[below]
            found.append((texts[here] * k + (mix(dart) % np.uint64(k)).astype(np.int64), rank[here], dart | np.uint64(1)))
        cell, ranks, names = (np.concatenate(x) for x in zip(*found))
        late_first = np.argsort(-ranks, kind="stable")
        signature[cell[late_first]] = names[late_first]  # the earliest is written last
        empty = (signature.reshape(n, k) == 0).any(axis=1)
        open_texts &= empty
        limit[open_texts] *= 2
    return signature.reshape(n, k)


def band_hashes(signatures: np.ndarray) -> np.ndarray:
    parts = signatures.reshape(len(signatures), BANDS, ROWS)
    out = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), parts.shape[:2])
    for row in range(ROWS):
        out = mix(out ^ parts[:, :, row])
    return out


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for some in batches_of_bytes(batch, "text", 1_500_000):
            words = normal_words(some.column("text"))
            n = some.num_rows
            bands = band_hashes(dart_signatures(*regions(*shingles(words)), n)).view(np.int64)
            counts = np.diff(words.first)
            place = np.arange(len(words.hash)) - np.repeat(words.first[:-1], counts)
            fps = []
            for seed in (1, 2):
                spiced = mix(words.hash + mix((place * 2 + seed).astype(np.uint64)))
                total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(spiced, dtype=np.uint64)])
                fps.append((total[words.first[1:]] - total[words.first[:-1]]).view(np.int64))
            sizes = np.diff(text_bytes(some.column("text"))[1])
            yield pa.RecordBatch.from_arrays(
                [
                    some.column("doc_id"),
                    some.column("text_key"),
                    pa.array(fps[0]),
                    pa.array(fps[1]),
                    pa.array(sizes, pa.int64()),
                    pa.array(np.where(counts > 0, np.maximum(counts - SHINGLE + 1, 1), 0), pa.int64()),
                    pa.array([b.tolist() if c else [] for b, c in zip(bands, counts.tolist())], pa.list_(pa.int64())),
                ],
                ["doc_id", "text_key", "fp1", "fp2", "n_bytes", "n_shingles", "bands"],
            )


def signatures(docs: DataFrame) -> DataFrame:
    """Signature rows of ``docs`` (doc_id, text): fingerprints of the word sequence, and bands."""
    rows = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_key"), F.col("text").cast("string"))
    return rows.mapInArrow(_sign, SIGNATURE_SCHEMA)


def _multiset(text: str) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(shingles(normal_words(pa.array([text], pa.string())))[0], return_counts=True)


def weighted_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    _, at, bt = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    shared = int(np.minimum(a[1][at], b[1][bt]).sum())
    whole = int(a[1].sum() + b[1].sum()) - shared
    return shared / whole if whole else 0.0


def _compare(least: float):
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        leader, held = None, None
        for batch in batches:
            linked = []
            for number, role, node, text in zip(*(batch.column(c) for c in ("leader", "role", "node", "text"))):
                if role.as_py() == 0:
                    leader, held = number.as_py(), _multiset(text.as_py())
                elif number.as_py() == leader and weighted_jaccard(held, _multiset(text.as_py())) >= least:
                    linked.append((leader, node.as_py()))
            columns = list(zip(*linked)) or [[], []]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["a", "b"])

    return compare


def verified(pairs: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """Those of ``pairs`` (leader, node, n_bytes) whose ``texts`` (node, text) are similar: (a, b).

    A leader with many members is copied, with a share of the members each.
    """
    tasks = F.greatest(F.ceil(F.sum("n_bytes") / VERIFY_BYTES), F.ceil(F.count("*") / VERIFY_ROWS))
    copies = pairs.groupBy("leader").agg(tasks.cast("int").alias("n_copies"))
    copies = materialise(copies, "leaders")
    copy = F.pmod(F.xxhash64("node"), F.greatest(F.col("n_copies"), F.lit(1))).cast("int").alias("copy")
    members = pairs.join(copies, "leader").select("leader", copy, F.lit(1).alias("role"), "node")
    leaders = copies.select(
        "leader",
        F.explode(F.sequence(F.lit(0), F.greatest(F.col("n_copies"), F.lit(1)) - 1)).alias("copy"),
        F.lit(0).alias("role"),
        F.col("leader").alias("node"),
    )
    wanted = members.unionByName(leaders).join(texts, "node")
    in_order = wanted.repartition("leader", "copy").sortWithinPartitions("leader", "copy", "role")
    return in_order.select("leader", "role", "node", "text").mapInArrow(_compare(least), "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """(node, component) of all linked nodes; a component is named after its smallest node.

    Labels go along links, and each label is then replaced by the label of the node it names.
    """
    edges = materialise(
        links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges"
    )
    labels = materialise(edges.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("a")).alias("component")), "labels")
    while True:
        heard = edges.join(labels, edges["b"] == labels["node"]).groupBy(F.col("a").alias("at")).agg(F.min("component").alias("heard"))
        nearer = labels.join(heard, labels["node"] == heard["at"]).select("node", "component", F.least("component", "heard").alias("next"))
        named = labels.select(F.col("node").alias("named"), F.col("component").alias("its"))
        jumped = nearer.join(named, nearer["next"] == named["named"]).select("node", "component", F.least("next", "its").alias("next"))
        moved = materialise(jumped, "labels")
        labels = moved.select("node", F.col("next").alias("component"))
        if moved.where("next <> component").isEmpty():
            return labels


def _pairs(met: DataFrame, least: float) -> DataFrame:
    """Each pair of ``met`` (head, its, node, n_shingles, n_bytes) once, as leader, node, n_bytes, low and high.

    Left out are pairs whose numbers of shingles, its and n_shingles, don't allow a similarity of ``least``.
    """
    alike = F.least("its", "n_shingles") / F.greatest("its", "n_shingles") >= F.lit(least)
    low, high = F.least("node", "head").alias("low"), F.greatest("node", "head").alias("high")
    once = met.where(alike).groupBy(low, high).agg(F.min("head").alias("leader"), F.max("n_bytes").alias("n_bytes"))
    return once.select("leader", F.when(F.col("leader") == F.col("low"), F.col("high")).otherwise(F.col("low")).alias("node"), "n_bytes", "low", "high")


def _open_members(members: DataFrame, links: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Components of ``links``; and members of buckets with several components: theirs, and the bucket's largest."""
    parts = components(links)
    placed = members.join(parts, "node", "left").select("bucket", "node", "n_bytes", "n_shingles", F.coalesce("component", "node").alias("component"))
    sizes = placed.groupBy("bucket", "component").agg(F.count("*").alias("size"))
    mixed = sizes.groupBy("bucket").agg(F.max(F.struct("size", "component")).alias("most"), F.count("*").alias("n_parts")).where("n_parts > 1")
    mixed = mixed.select("bucket", F.col("most.component").alias("largest"))
    return parts, materialise(placed.join(mixed, "bucket"), "placed")


def _groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.RecordBatch]:
    """The rows of each combination of ``keys``, which come one after the other."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        values = np.stack([batch.column(k).to_numpy(zero_copy_only=False) for k in keys], axis=1)
        starts = [0, *(np.flatnonzero((values[1:] != values[:-1]).any(axis=1)) + 1).tolist()] if len(values) else []
        for start, end in zip(starts, [*starts[1:], len(values)]):
            key = tuple(values[start].tolist())
            if key != last and held:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held = []
            held.append(batch.slice(start, end - start))
            last = key
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def shared_regions(units: np.ndarray, texts: np.ndarray, mine: np.ndarray, others: np.ndarray, n: int) -> np.ndarray:
    """Number of regions that each text of ``mine`` shares with each of ``others``, of ``n`` texts."""
    row = np.full((2, n), -1)
    row[0, mine], row[1, others] = np.arange(len(mine)), np.arange(len(others))
    _, column = np.unique(units, return_inverse=True)
    in_mine, in_others = row[0, texts] >= 0, row[1, texts] >= 0
    useful = np.zeros(column.max(initial=-1) + 1, bool)
    useful[column[in_mine]] = True
    useful &= np.bincount(column[in_others], minlength=len(useful)) > 0
    useful &= np.bincount(column, minlength=len(useful)) > 1
    number = np.cumsum(useful) - 1
    at = np.flatnonzero(useful[column])
    at = at[np.argsort(number[column[at]], kind="stable")]
    column, texts = number[column[at]], texts[at]
    shared = np.zeros((len(mine), len(others)), np.float32)  # whole numbers below 2^24 are exact
    for begin in range(0, int(useful.sum()), REGIONS_AT_ONCE):
        some = slice(*np.searchsorted(column, [begin, begin + REGIONS_AT_ONCE]))
        sides = []
        for side, size in ((0, len(mine)), (1, len(others))):
            there = row[side, texts[some]] >= 0
            matrix = np.zeros((size, REGIONS_AT_ONCE), np.float32)
            matrix[row[side, texts[some]][there], column[some][there] - begin] = 1
            sides.append(matrix)
        shared += sides[0] @ sides[1].T
    return shared


def spanning(pairs: Iterator[tuple[int, int]]) -> Iterator[int]:
    """Places of those ``pairs`` that join two components not joined by earlier ones."""
    over: dict[int, int] = {}

    def top(x: int) -> int:
        while over.get(x, x) != x:
            over[x] = over.get(over[x], over[x])
            x = over[x]
        return x

    for place, (x, y) in enumerate(pairs):
        x, y = top(x), top(y)
        if x != y:
            over[max(x, y)] = min(x, y)
            yield place


def _compare_cells(least: float):
    def links_of(cell: pa.RecordBatch) -> pa.RecordBatch:
        node, component, mine, others = (cell.column(c).to_numpy(zero_copy_only=False) for c in ("node", "component", "mine", "other"))
        mine, others = np.flatnonzero(mine), np.flatnonzero(others)
        units, texts = regions(*shingles(normal_words(cell.column("text"))))
        shared = shared_regions(units, texts, mine, others, cell.num_rows).astype(np.float64)
        weight = np.bincount(texts, minlength=cell.num_rows)
        whole = weight[mine][:, None] + weight[others][None, :] - shared
        a, b = np.nonzero((shared >= least * whole - 1e-6) & (component[mine][:, None] != component[others][None, :]))
        alike = shared[a, b] / whole[a, b] >= least
        a, b = mine[a[alike]], others[b[alike]]
        keep = list(spanning(zip(component[a].tolist(), component[b].tolist())))
        return pa.RecordBatch.from_arrays([pa.array(node[a[keep]], pa.int64()), pa.array(node[b[keep]], pa.int64())], ["a", "b"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell in _groups(batches, ["bucket", "i", "j"]):
            yield links_of(cell)

    return compare


def _cell_links(placed: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """Links (a, b) that join all components of a bucket which a similar pair of its members joins.

    Of two members in different components one at least is outside the bucket's largest: members
    outside are dealt into slices i, all members into slices j, and cell (i, j) compares the two. A
    member comes once into a cell, whichever side it is on.
    """
    outside = F.col("component") != F.col("largest")
    slices = lambda n, size: F.greatest(F.ceil(n / SLICE_ROWS), F.ceil(size / SLICE_BYTES), F.lit(1)).cast("int")
    sizes = placed.groupBy("bucket").agg(
        slices(F.count(F.when(outside, 1)), F.coalesce(F.sum(F.when(outside, F.col("n_bytes"))), F.lit(0))).alias("si"),
        slices(F.count("*"), F.sum("n_bytes")).alias("sj"),
    )
    dealt = placed.withColumn("outside", outside).join(sizes, "bucket")
    for name, n, seed in (("own_i", "si", 1), ("own_j", "sj", 2)):
        dealt = dealt.withColumn(name, F.pmod(F.xxhash64("node", F.lit(seed)), F.col(n)).cast("int"))
    cell = lambda i, j: F.struct(i.alias("i"), j.alias("j"))
    numbers = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    none = F.array().cast("array<struct<i:int,j:int>>")
    of_mine = F.when(F.col("outside"), F.transform(numbers("sj"), lambda j: cell(F.col("own_i"), j))).otherwise(none)
    of_others = F.transform(numbers("si"), lambda i: cell(i, F.col("own_j")))
    dealt = dealt.withColumn("cell", F.explode(F.array_union(of_mine, of_others))).select(
        "bucket",
        "cell.i",
        "cell.j",
        "node",
        "component",
        (F.col("outside") & (F.col("own_i") == F.col("cell.i"))).alias("mine"),
        (F.col("own_j") == F.col("cell.j")).alias("other"),
    )
    in_order = dealt.join(texts, "node").repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j")
    columns = in_order.select("bucket", "i", "j", "node", "component", "mine", "other", "text")
    return columns.mapInArrow(_compare_cells(least), "a long, b long")


def near_duplicates(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """Class of every row of ``docs`` (doc_id, text): doc_id, text_key, class_id, class_node.

    Rows are in one class if a chain of pairs with a weighted Jaccard similarity of ``least``
    links them; class_id is the smallest id in the class. Texts with the same words are
    copies. Rows without words are alone; rows that share an id are judged by their texts,
    whatever the id; a null id is never the smallest, and class_id is null in a class without
    ids; no rows give no rows. ``class_node`` tells classes apart that share a class_id.
    """
    signed = materialise(signatures(docs), "signatures")
    with_words = signed.where(F.size("bands") > 0)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key", "n_bytes", "n_shingles")).alias("rep")
    copies = with_words.groupBy("fp1", "fp2").agg(first, F.first("bands").alias("bands"))
    # numbers of the texts, fixed as they are written
    reps = materialise(copies.select("fp1", "fp2", "rep.*", "bands", F.monotonically_increasing_id().alias("node")), "representatives")

    buckets = reps.select("node", "n_bytes", "n_shingles", F.explode("bands").alias("bucket"))
    shared = materialise(buckets.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1"), "buckets")
    members = materialise(buckets.join(shared, "bucket"), "members")
    nodes = members.select("node").distinct()
    # ids as keys that are never null
    key = F.struct(F.col("doc_id").isNull(), F.coalesce("doc_id", F.lit(0))).alias("id")
    chosen = materialise(reps.join(nodes, "node").select("node", "text_key", key), "chosen")
    # the join and the removal of repeated rows go by the same keys, in one shuffle
    keyed = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), F.xxhash64("text").alias("text_key"))
    keyed = keyed.select(key, "text_key", "text")
    if chosen.count() <= BROADCAST_CANDIDATES:
        keyed = keyed.join(F.broadcast(chosen.select("text_key")), "text_key", "left_semi")
    wanted = keyed.join(chosen, ["id", "text_key"]).dropDuplicates(["id", "text_key"])
    texts = materialise(wanted.select("node", "text"), "texts")

    scores = members.groupBy("node").agg(F.sum("n").alias("score"))
    ranked = members.join(scores, "node").select("bucket", "score", "node", "n_shingles")
    hubs = ranked.groupBy("bucket").agg(F.max(F.struct("score", "node", "n_shingles")).alias("hub"))
    hubs = materialise(hubs.select("bucket", F.col("hub.score").alias("score"), F.col("hub.node").alias("head"), F.col("hub.n_shingles").alias("its")), "hubs")
    met = members.join(hubs, "bucket").where(F.col("node") != F.col("head"))
    met = met.groupBy("node").agg(F.max(F.struct("score", "head", "its")).alias("hub"), F.max("n_bytes").alias("n_bytes"), F.max("n_shingles").alias("n_shingles"))
    tried = materialise(_pairs(met.select("node", "n_bytes", "n_shingles", "hub.head", "hub.its"), least), "pairs")
    links = materialise(verified(tried, texts, least), "links")

    parts, placed = _open_members(members, links)
    heads = hubs.join(placed.select("bucket", F.col("node").alias("head"), F.col("component").alias("other")), ["bucket", "head"])
    met = placed.join(heads, "bucket").where("component <> other")
    fresh = materialise(_pairs(met, least).join(tried.select("low", "high"), ["low", "high"], "left_anti"), "pairs")
    more = materialise(verified(fresh, texts, least), "links")
    links = links.unionByName(more)

    _, placed = _open_members(members, links)
    more = materialise(_cell_links(placed, texts, least), "links")
    links = links.unionByName(more)
    parts = components(links)

    named = reps.select("fp1", "fp2", "node", "doc_id").join(parts, "node", "left")
    named = materialise(named.select("fp1", "fp2", "doc_id", F.coalesce("component", "node").alias("class_node")), "classes")
    smallest = named.groupBy("class_node").agg(F.min("doc_id").alias("class_id"))
    to_class = named.join(smallest, "class_node").select("fp1", "fp2", "class_id", "class_node")
    classed = with_words.join(to_class, ["fp1", "fp2"]).select("doc_id", "text_key", "class_id", "class_node")
    number = F.lit(ALONE) + F.monotonically_increasing_id()
    alone = signed.where(F.size("bands") == 0).select("doc_id", "text_key", F.col("doc_id").alias("class_id"), number.alias("class_node"))
    return classed.unionByName(alone)


def one_of_each(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """The rows and columns of ``docs``, one row of each class: the smallest id's, text hash on a tie.

    Columns named _near_key, _near_doc and _near_text are removed.
    """
    classes = near_duplicates(docs, least)
    pick = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")).alias("pick")
    kept = classes.groupBy("class_node").agg(pick).select(F.col("pick.doc_id").alias("_near_doc"), F.col("pick.text_key").alias("_near_text"))
    kept = materialise(kept, "kept")
    inner = docs.drop("_near_key", "_near_doc", "_near_text").withColumn("_near_key", F.xxhash64("text"))
    same = inner["doc_id"].eqNullSafe(kept["_near_doc"]) & (inner["_near_key"] == kept["_near_text"])
    names = [c for c in inner.columns if c != "_near_key"]
    joined = inner.join(kept, same).dropDuplicates(["doc_id", "_near_key"])
    return joined.select(*names)
