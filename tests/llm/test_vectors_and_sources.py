"""Hard negatives, embedding near duplicates and the source audit against brute force and odd inputs."""

import collections
import itertools
import re

import numpy as np
import pytest
from conftest import SF

from tickloom.llm import hard_negatives, lattice_dedup, source_audit

VECTOR_ROWS = "vec_id long, embedding array<float>, label int, row long, node long, cell long, score long"


def _vectors(spark, rows):
    return spark.createDataFrame([(i, v, label, 1, 2, 3, 4) for i, v, label in rows], VECTOR_ROWS)


def _clusters(seed, n, dims, cosine, size):
    """``n`` unit vectors: half alone, half in clusters whose members have about ``cosine`` with one another."""
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((n // 2 // size, dims))
    near = np.repeat(centres / np.linalg.norm(centres, axis=1)[:, None], size, axis=0)
    noise = rng.standard_normal(near.shape) / np.sqrt(dims)
    members = np.sqrt(cosine) * near + np.sqrt(1 - cosine) * noise
    rest = rng.standard_normal((n - len(members), dims))
    out = np.concatenate([members, rest])
    return (out / np.linalg.norm(out, axis=1)[:, None]).astype(np.float32)[rng.permutation(n)]


NAN, INF = float("nan"), float("inf")
ODD_VECTORS = [
    (None, [1.0, 0.0], 1),
    (1, None, 1),
    (2, [1.0, None], 1),
    (3, [NAN, 0.0], 1),
    (4, [INF, 0.0], 1),
    (5, [0.0, 0.0], 1),
    (6, [], 1),
    (7, [1.0, 0.0], None),
    (8, [2.0, 0.0], 2),
    (8, [2.0, 0.0], 2),
    (9, [0.0, 1.0, 0.0], 2),
    (0, [1.0, 0.5], 1),
    (0, [1.0, 0.5], 1),
    (100, [-1.0, 0.25], 2),
    (10, [1.0, 0.25], 2),
    (11, [1.0, 0.25], 3),
    (200, [0.5, 0.5], 1),
]


# --- hard negatives --------------------------------------------------------------------------


def _brute_negatives(rows):
    usable = [(i, [int(np.floor(256 * float(x))) for x in v], label) for i, v, label in rows if i is not None and label is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = collections.Counter()
    for a, (anchor, vector, label) in enumerate(usable):
        if anchor % 100:
            continue
        scored = [(-sum(x * y for x, y in zip(vector, v)), i, other) for b, (i, v, other) in enumerate(usable) if a != b]
        for minus, positive, _ in sorted(s for s in scored if s[2] == label)[:5]:
            fits = sorted(s for s in scored if s[2] != label and -30 * minus <= -100 * s[0] <= -90 * minus)
            for rank, (score, negative, _) in enumerate(fits[:10], 1):
                out[(anchor, positive, rank, negative, -minus, -score)] += 1
    return out


@pytest.mark.parametrize("anchor_bytes", [None, 1])
def test_negatives_of_odd_rows(spark, monkeypatch, anchor_bytes):
    if anchor_bytes:  # a block for each anchor
        monkeypatch.setattr(hard_negatives, "ANCHOR_BYTES", anchor_bytes)
    got = hard_negatives.mine_hard_negatives(_vectors(spark, ODD_VECTORS))
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    expected = _brute_negatives(ODD_VECTORS)
    assert collections.Counter(tuple(r) for r in got.collect()) == expected and len(expected) > 3
    assert hard_negatives.mine_hard_negatives(_vectors(spark, ODD_VECTORS).where("false")).count() == 0


@pytest.mark.parametrize("scale", [1.0, 1e7])
def test_negatives_equal_brute_force(spark, scale):
    """Clusters that hold several labels, a hot label, many ties, and products beyond a double's whole numbers."""
    vectors = _clusters(5, 1200, 70, 0.8, 60)
    vectors[100:140] = vectors[100]
    rows = [(i, (scale * v).astype(np.float32).tolist(), 0 if i % 3 else i % 10) for i, v in enumerate(vectors)]
    got = hard_negatives.mine_hard_negatives(_vectors(spark, rows).repartition(3)).collect()
    assert collections.Counter(tuple(r) for r in got) == _brute_negatives(rows)


def test_intervals_hold_the_scores_and_shrink_with_levels():
    rng = np.random.default_rng(6)
    vectors = np.floor(256 * _clusters(7, 400, 128, 0.9, 20)).astype(np.int64)
    vectors[:3] = [[0] * 128, [1] + [0] * 127, [5000] * 128]
    codes, shares, rest, norm = hard_negatives.encode(vectors.astype(float))
    ones = np.bitwise_count(codes).sum(axis=2, dtype=np.int64)
    for at in rng.integers(0, 400, 20):
        low, high = hard_negatives.Query(vectors[at].astype(float)).interval(codes, shares, rest, norm, ones)
        scores = vectors @ vectors[at]
        assert (low <= scores).all() and (scores <= high).all()
    assert np.median(rest[3:]) < 0.2


# --- embedding near duplicates ---------------------------------------------------------------


def test_decoded_points_are_the_nearest_of_the_lattice():
    roots = lattice_dedup.e8_roots()
    assert len({tuple(r) for r in roots}) == 240 and ((roots**2).sum(axis=1) == 2).all()
    points = np.random.default_rng(1).standard_normal((500, 8)) * 3
    near = lattice_dedup.decode_e8(points)
    doubled = 2 * near
    assert (doubled == np.rint(doubled)).all() and (np.ptp(doubled % 2, axis=1) == 0).all() and (near.sum(axis=1) % 2 == 0).all()
    distance = ((points - near) ** 2).sum(axis=1)
    others = ((points[:, None, :] - near[:, None, :] - roots[None]) ** 2).sum(axis=2)
    assert (distance[:, None] <= others + 1e-9).all()


def _brute_links(vectors):
    unit = vectors.astype(float) / np.linalg.norm(vectors.astype(float), axis=1)[:, None]
    linked = unit @ unit.T >= lattice_dedup.COSINE
    label = np.arange(len(vectors))
    while True:
        nearer = np.array([label[row].min() for row in linked])
        nearer = nearer[nearer]
        if (nearer == label).all():
            return linked.sum(axis=1) - 1, label
        label = nearer


@pytest.mark.parametrize("slice_size", [2_000, 40])
@pytest.mark.parametrize("cosine", [0.9, 0.97])
def test_links_against_brute_force(spark, monkeypatch, slice_size, cosine):
    """Clusters around the threshold and above it, whose cells are cut into slices or not; copies, too."""
    monkeypatch.setattr(lattice_dedup, "SLICE", slice_size)
    vectors = _clusters(2, 1600, 64, cosine, 200)
    vectors[1000:1100] = vectors[1000] * np.linspace(0.5, 2, 100, dtype=np.float32)[:, None] ** 0
    n, label = _brute_links(vectors)
    got = lattice_dedup.near_vectors(_vectors(spark, [(i, v.tolist(), 1) for i, v in enumerate(vectors)]).repartition(3)).toPandas().sort_values("vec_id")
    assert (got.n_links.to_numpy() <= n).all()
    assert got.n_links.sum() >= 0.95 * n.sum() > 1000
    assert (got.component_id.to_numpy() == label).mean() > 0.97 and (got.kept.to_numpy() == (got.vec_id == got.component_id).to_numpy()).all()
    assert not (got.component_id.to_numpy() < label).any()  # nothing is linked that isn't


def test_links_of_odd_rows(spark):
    got = collections.Counter(tuple(r) for r in lattice_dedup.near_vectors(_vectors(spark, ODD_VECTORS)).collect())
    # (1, 0) of a null id, of 7, and (2, 0) twice link; so do (1, 0.25) twice, and with (1, 0.5) twice
    east = {(None, 5, 7, False): 1, (7, 5, 7, True): 1}
    assert sum(got.values()) == len(ODD_VECTORS)
    for alone in (1, 2, 3, 4, 5, 6):
        assert got[(alone, 0, alone, True)] == 1
    assert got[(9, 0, 9, True)] == 1 and got[(100, 0, 100, True)] == 1
    vectors = [(i, v) for i, v, _ in ODD_VECTORS if v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    full = np.array([(v + [0.0, 0.0])[:3] for _, v in vectors])
    n, label = _brute_links(full)
    ids = [i for i, _ in vectors]
    smallest = {k: min((i for i, name in zip(ids, label) if name == k and i is not None), default=None) for k in set(label)}
    expected = collections.Counter((i, int(k), smallest[name], i == smallest[name]) for i, k, name in zip(ids, n, label))
    assert all(got[key] == times for key, times in expected.items()), (got, expected, east)
    empty = lattice_dedup.near_vectors(_vectors(spark, ODD_VECTORS).where("false"))
    assert empty.columns == ["vec_id", "n_links", "component_id", "kept"] and empty.count() == 0


# --- source audit ----------------------------------------------------------------------------


def _brute_audit(rows, least, ranks):
    held = [(lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))) for lang, source, text in rows]
    out = set()
    for lang in {h[0] for h in held}:
        docs = collections.Counter(t for name, _, words in held if name == lang for t in set(words))
        kept = {t for t, n in docs.items() if n >= least}
        groups = {}
        for name, source, words in held:
            if name == lang:
                groups.setdefault(source, collections.Counter()).update(w for w in words if w in kept)
        whole = sum(groups.values(), collections.Counter())

        def p(counts, term):
            return 1 + 10**9 * (counts[term] + 5) // (sum(counts.values()) + 5 * len(kept))

        for source, counts in groups.items():
            pairs = [(sum(abs(p(counts, t) - p(other, t)) for t in kept), item) for item, other in groups.items() if item != source]
            terms = [(p(counts, t) - p(whole, t), t) for t in kept if counts[t]]
            for part, found in (("pair", pairs), ("term", [x for x in terms if x[0] > 0])):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                for rank, (value, item) in enumerate(found if part == "pair" else found[:ranks], 1):
                    out.add((lang, source, part, item, value, rank))
    return out


@pytest.fixture(scope="module")
def sourced(spark):
    """Ties, a hot source, groups without terms, null and empty fields, repeated rows, a long text, clashing columns."""
    words = ["a", "B", "é", "ñu", "zz", "x9y", "Ünder_score", "\x85"]
    rows = [(["en", "de", None][i % 3], ["hot", "hot", "s1", "s2", None][i % 5], " ".join(itertools.islice(itertools.cycle(words[i % 4 :]), i % 13))) for i in range(200)]
    rows += [("fr", "s1", None), ("fr", "", "12 34"), ("fr", None, ""), ("xx", "one", "word"), ("en", "s9", ""), ("en", "s1", "long " * 50_000)] + rows[:7]
    columns = "lang string, source string, text string, term string, n long, value long, rank int, block int"
    return spark.createDataFrame([(*r, "t", 1, 2, 3, 4) for r in rows], columns), rows


@pytest.mark.parametrize("sizes", [None, (3, 2, 2)])
@pytest.mark.parametrize("least, ranks", [(30, 50), (5, 2), (10_000, 50)])
def test_audit_equals_brute_force(sourced, monkeypatch, sizes, least, ranks):
    if sizes:  # several partial counts, blocks of terms, and parts of a block's sources
        for name, size in zip(("HELD_TERMS", "BLOCK", "SOURCES"), sizes):
            monkeypatch.setattr(source_audit, name, size)
    docs, rows = sourced
    got = [tuple(r) for r in source_audit.audit_sources(docs.repartition(3), least, ranks).collect()]
    assert len(got) == len(set(got)) and set(got) == _brute_audit(rows, least, ranks)
    assert source_audit.audit_sources(docs.where("false")).count() == 0


def test_shares_are_exact_for_large_counts(spark):
    from pyspark.sql import functions as F

    pairs = [(7 * 10**11, 9 * 10**15), (1, 3), (0, 5), (10**12, 10**12), (123456789012345, 9 * 10**15 - 1)]
    got = spark.createDataFrame(pairs, "a long, b long").select("a", "b", source_audit.per_billion(F.col("a"), F.col("b")).alias("v")).collect()
    assert all(r["v"] == 10**9 * r["a"] // r["b"] for r in got)


def test_recall_on_the_given_embeddings(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").toPandas().sort_values("vec_id")
    n, label = _brute_links(np.array(rows.embedding.tolist()))
    got = lattice_dedup.near_vectors(spark.read.parquet(f"{SF}/embeddings.parquet")).toPandas().sort_values("vec_id")
    assert (got.n_links.to_numpy() <= n).all() and got.n_links.sum() >= 0.9 * n.sum()
