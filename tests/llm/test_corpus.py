"""Corpus operators against SQL, brute force, exact round trips and odd inputs."""

import collections
import math
import random
import re
import zlib
from html.parser import HTMLParser

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from compare import check
from conftest import SF
from pyspark.sql import functions as F

import corpus_pipeline
from tickloom.llm import decontamination, line_dedup, near_dedup, packing, quality, registry, sharding, substring_dedup, token_file, tokens
from tickloom.llm import url_filter, warc
from tickloom.session import run_dir

BYTE_BPE, WORD_BPE = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
LONG = " ".join(f"w{i}" for i in range(30_000))
PASSAGE = " ".join(f"shared{i}" for i in range(60))
ODD_TEXTS = [None, "", " \n\t", "one", "a  b\n\nc ", "é ñ́ ß\x1c x\x85y", PASSAGE, PASSAGE, "before " + PASSAGE + " after it", LONG, "x" * 5000, "<|endoftext|> don't"]


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and long texts, repeated rows, ids that repeat, columns with clashing names."""
    rows = [(i if i else None, text, "en" if i % 2 else None, "src", 1, 7, 8, "z") for i, text in enumerate(ODD_TEXTS)]
    rows += [rows[6], (7, "another text under an id already used", "en", "src", 1, 7, 8, "z")]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, n_words long, row_key long, _map_doc string"
    )


@pytest.fixture(scope="module")
def empty(odd):
    return odd.where("false")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(6, 1), (None, 0), (6, 0), (9, None)], "doc_id long, quality int")


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([(1, PASSAGE), (2, None), (3, ""), (4, "one")], "item_id long, text string")


@pytest.mark.parametrize("name", list(registry.all_oracles()))
def test_query_equals_sql(spark, name):
    problem, rows = check(spark, SF, name)
    assert problem is None, problem
    assert rows > 0


# --- tokens, packing, token files ---------------------------------------------------------


def _reference_ids(path, texts):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    return [e.ids for e in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]


@pytest.mark.parametrize("path", [BYTE_BPE, WORD_BPE])
def test_word_by_word_ids_are_the_tokenizers(spark, path):
    texts = [*ODD_TEXTS, "a \n b", "ΑΣ, İ.", " lead", "trail ", "a\n"] + [r[0] for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").collect()]
    ids, counts = tokens.WordEncoder(path).encode(pa.array(texts, pa.string()))
    at = 0
    for expected, count in zip(_reference_ids(path, texts), counts.tolist()):
        assert ids[at : at + count].tolist() == expected
        at += count


@pytest.mark.parametrize("high", [1, 2, 300, 50_000, 2**32 - 1])
@pytest.mark.parametrize("n", [0, 1, 255, 256, 257, 3000])
def test_blocks_round_trip(n, high):
    rng = np.random.default_rng(n)
    ids = rng.integers(0, high, n, dtype=np.uint64).astype(np.uint32)
    if n > 10:
        ids[rng.integers(0, n, 5)] = 2**32 - 1
    payload, starts = token_file.encode_blocks(ids)
    assert (token_file.decode_blocks(payload, starts) == ids).all()
    for block in range(len(starts) - 1):
        assert (token_file.decode_block(payload, starts, block) == ids[block * token_file.BLOCK :][: token_file.BLOCK]).all()


def test_token_files(spark, odd, empty):
    folder = run_dir(spark, "tokens")
    token_file.write_token_files(odd, WORD_BPE, 1, folder)
    got = sorted((r["start"], r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in token_file.read_documents(spark, folder).collect())
    rows = odd.select("doc_id", "text").collect()
    expected = collections.Counter()
    for row, ids in zip(rows, _reference_ids(WORD_BPE, [r["text"] for r in rows])):
        expected[(row["doc_id"], len(ids) + 1, zlib.crc32(np.array([*ids, 1], "<u4").tobytes()))] += 1
    assert collections.Counter(g[1:] for g in got) == expected
    assert [g[0] for g in got] == [0, *np.cumsum([g[2] for g in got])[:-1].tolist()]
    ids = [g[1] if g[1] is not None else -1 for g in got]
    assert ids == sorted(ids)
    none = run_dir(spark, "tokens")
    token_file.write_token_files(empty, WORD_BPE, 1, none)
    assert token_file.read_documents(spark, none).count() == 0


def _check_packing(rows, capacity):
    bins = collections.defaultdict(list)
    for r in rows:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for held in bins.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins)


def test_packing(spark, odd, empty):
    rows = packing.pack_documents(odd, BYTE_BPE, 2).collect()
    _check_packing(rows, 1024)
    source = odd.select("doc_id", "text").collect()
    expected = collections.Counter()
    for row, ids in zip(source, _reference_ids(BYTE_BPE, [r["text"] for r in source])):
        ids, at = [*ids, 2], 0
        first = (len(ids) - 1) % 1024 + 1
        for piece, size in enumerate([first] + [1024] * ((len(ids) - first) // 1024)):
            expected[(row["doc_id"], piece, at, size, zlib.crc32(np.array(ids[at : at + size], "<u4").tobytes()))] += 1
            at += size
    assert collections.Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == expected
    assert packing.pack_documents(empty, BYTE_BPE, 2).count() == 0


def test_packing_over_many_blocks_is_near_the_bound(spark):
    lengths = np.random.default_rng(3).integers(1, 1024, 10_000)
    pieces = spark.createDataFrame([(i, int(n)) for i, n in enumerate(lengths)], "key long, length int")
    rows = pieces.join(packing.pack(pieces), "key").collect()
    assert sorted(r["key"] for r in rows) == list(range(10_000))
    assert _check_packing(rows, 1024) <= math.ceil(lengths.sum() / 1024) * 1.01


def test_genetic_steps_keep_every_piece():
    rng = np.random.default_rng(5)
    sizes = rng.integers(1, 400, 300)
    a, b = packing.fresh(sizes, 1024, 0.0, rng), packing.fresh(sizes, 1024, 0.3, rng)
    for child in (packing.crossover(a, b, sizes, 1024, rng), packing.mutate(a, sizes, 1024, rng)):
        assert len(child) == 300 and np.bincount(child, sizes).max() <= 1024
    best = packing.evolve(sizes, [], 1024, 10, rng)[0]
    assert best.max() <= a.max()


# --- duplicates ------------------------------------------------------------------------------


def _brute_classes(rows, least=0.8):
    sets = [near_dedup._multiset(r["text"] or "") for r in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if near_dedup.weighted_jaccard(sets[i], sets[j]) >= least:
                parent[find(i)] = find(j)
    return [find(i) for i in range(len(rows))]


def test_near_duplicates_equal_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = docs.select("doc_id", "text").collect()
    classes = collections.defaultdict(list)
    for row, root in zip(rows, _brute_classes(rows)):
        classes[root].append(row["doc_id"])
    expected = {i: min(ids) for ids in classes.values() for i in ids}
    got = {r["doc_id"]: r["class_id"] for r in near_dedup.near_duplicates(docs).collect()}
    assert got == expected


def _quick_brute_classes(texts, least=0.8):
    """As _brute_classes, for many texts without repeated shingles: the numbers of shared ones are a product of matrices."""
    held = [near_dedup._multiset(t)[0] for t in texts]
    names, holders = np.unique(np.concatenate(held), return_counts=True)
    common = names[holders > 1]
    has = np.array([np.isin(common, h) for h in held], np.float32)
    shared = has @ has.T
    n = np.array([len(h) for h in held])
    linked = shared / (n[:, None] + n[None, :] - shared) >= least
    label = np.arange(len(texts))
    while True:
        nearer = np.array([label[row].min() for row in linked])
        if (nearer == label).all():
            return label
        label = nearer


def test_copies_of_a_text_in_the_middle_are_one_class(spark):
    """Copies like their source, unlike one another, and the source's id amid theirs."""
    rng = random.Random(8)
    source = [f"w{i}" for i in range(300)]
    texts = []
    for i in range(2001):
        words = list(source)
        for at in rng.sample(range(6, 294, 6), 6) if i != 1000 else ():
            words[at] = f"own{i}x{at}"
        texts.append(" ".join(words))
    label = _quick_brute_classes(texts)
    alone = _quick_brute_classes([t for i, t in enumerate(texts) if i != 1000])
    assert (label == 0).all() and len(set(alone)) > 1
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["class_id"] for r in near_dedup.near_duplicates(docs).collect()}
    assert got == dict(enumerate(label.tolist()))


def test_links_between_any_two_members_of_large_buckets(spark):
    """Pairs of like texts amid many texts a little too far from all others."""
    rng = random.Random(9)
    source = [f"w{i}" for i in range(400)]
    texts = []
    for i in range(150):
        words = list(source)
        edits = rng.sample(range(6, 394, 6), 14)
        for at in edits[:6]:
            words[at] = f"own{i}x{at}"
        near = list(words)
        for at in edits[6:]:
            near[at] = f"near{i}x{at}"
        texts += [" ".join(words), " ".join(near)]
    rng.shuffle(texts)
    label = _quick_brute_classes(texts)
    assert len(set(label)) > 50
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["class_id"] for r in near_dedup.near_duplicates(docs).collect()}
    assert got == dict(enumerate(label.tolist()))


@pytest.mark.parametrize("most", [4_000_000, -1])
def test_near_duplicates_of_odd_rows(odd, empty, monkeypatch, most):
    monkeypatch.setattr(near_dedup, "BROADCAST_CANDIDATES", most)
    found = near_dedup.near_duplicates(odd)
    got = collections.Counter((r["doc_id"], r["class_id"]) for r in found.collect())
    assert got[(6, 6)] == 2 and got[(7, 6)] == got[(8, 6)] == 1 and got[(7, 7)] == got[(None, None)] == got[(9, 9)] == 1
    kept = near_dedup.one_of_each(odd)
    assert kept.columns == odd.columns
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 1, 2, 3, 4, 5, 6, 7, 9, 10, 11]
    assert near_dedup.near_duplicates(empty).count() == 0 and near_dedup.one_of_each(empty).count() == 0


def test_darts_estimate_weighted_similarity():
    random.seed(4)
    a = [random.choice("abcdefgh") * random.randint(1, 3) for _ in range(600)]
    b = [w if random.random() > 0.02 else "zz" for w in a]
    column = pa.array([" ".join(a), " ".join(b), "", "one"])
    words = near_dedup.normal_words(column)
    signed = near_dedup.dart_signatures(*near_dedup.regions(*near_dedup.shingles(words)), 4, 2000, 2000 * 10)
    truth = near_dedup.weighted_jaccard(near_dedup._multiset(column[0].as_py()), near_dedup._multiset(column[1].as_py()))
    assert abs((signed[0] == signed[1]).mean() - truth) < 0.05
    assert not signed[2].any() and signed[3].all()


def _brute_repeats(rows):
    words = [(r["doc_id"] if r["doc_id"] is not None else 2**63, re.findall(r"[^\x20\x09-\x0D]+", r["text"] or "")) for r in rows]
    least = {}
    for name, held in words:
        for i in range(len(held) - 12):
            key = tuple(held[i : i + 13])
            least[key] = min(least.get(key, name), name)
    for name, held in words:
        gone = {j for i in range(len(held) - 12) if least[tuple(held[i : i + 13])] < name for j in range(i, i + 13)}
        yield (None if name == 2**63 else name, len(held), len(gone), " ".join(w for j, w in enumerate(held) if j not in gone))


@pytest.mark.parametrize("sizes", [None, (5, 2)])
def test_repeats_of_odd_rows(odd, empty, monkeypatch, sizes):
    if sizes:
        monkeypatch.setattr(substring_dedup, "plan_sizes", lambda total: sizes)
    got = collections.Counter(tuple(r) for r in substring_dedup.remove_repeats(odd).collect())
    assert got == collections.Counter(_brute_repeats(odd.select("doc_id", "text").collect()))
    assert substring_dedup.remove_repeats(empty).count() == 0


def test_texts_without_an_id_are_dealt_to_many_groups(spark):
    docs = spark.range(400).select(F.lit(None).cast("long").alias("doc_id"), F.concat(F.lit("text "), F.col("id").cast("string")).alias("text"))
    sizes = [r["count"] for r in substring_dedup.dealt(docs, 8).groupBy("batch").count().collect()]
    assert len(sizes) == 8 and max(sizes) < 100


def test_lines_of_odd_rows(spark, odd, empty):
    line = "A line that is long enough to be a key of its own"
    texts = [f"head {i}\n  {line.upper() if i % 2 else line}\t\ntail" for i in range(6)]
    rows = [(i + 100, t) for i, t in enumerate(texts)] + [(100, texts[0]), (None, line)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r["doc_id"], r["n_lines"], r["n_dropped"], r["text"]) for r in line_dedup.dedup_lines(docs).collect()}
    expected = {(i + 100, 3, 1, f"head {i}\ntail") for i in range(5)} | {(105, 3, 0, texts[5]), (None, 1, 1, "")}
    assert got == expected
    kept = line_dedup.dedup_lines(odd)
    assert kept.count() == odd.count() and kept.where("n_dropped > 0").count() == 0
    assert line_dedup.dedup_lines(empty).count() == 0


def test_hot_lines_take_the_other_route_to_the_same_result(spark):
    line = "this very common line stands in every one of the documents"
    docs = spark.createDataFrame([(i, f"{line}\nown {i}\n{line}") for i in range(200)], "doc_id long, text string")
    lines = line_dedup.line_rows(docs, 40)
    assert line_dedup.hot_keys(lines).count() == 1
    rows = line_dedup.dedup_lines(docs).collect()
    assert all(r["n_dropped"] == (0 if r["doc_id"] == 199 else 2) for r in rows)


# --- filters ------------------------------------------------------------------------------------


def test_overlaps_of_odd_rows(odd, items, empty):
    found = {(r["doc_id"], r["n_hit"], tuple(r["item_ids"])) for r in decontamination.find_overlaps(odd, items).where("contaminated").collect()}
    assert found == {(3, 1, ("4",)), (6, 60, ("1",)), (7, 60, ("1",)), (8, 60, ("1",))}
    parted = {(r["doc_id"], r["n_hit"], tuple(r["item_ids"])) for r in decontamination.find_overlaps(odd, items, most=10).where("contaminated").collect()}
    assert parted == found
    spans = decontamination.find_overlaps(odd, items).where("doc_id = 8").first()["spans"]
    text = "before " + PASSAGE + " after it"
    assert [text[s["start"] : s["end"]] for s in spans] == [PASSAGE]
    assert decontamination.find_overlaps(empty, items).count() == 0
    assert decontamination.find_overlaps(odd, items.where("false")).where("contaminated").count() == 0
    kept = decontamination.clean_documents(odd, items)
    assert kept.columns == odd.columns and {3, 6, 7, 8}.isdisjoint(r["doc_id"] for r in kept.collect())


def test_overlaps_are_the_same_in_parts(spark, odd, items):
    """Rows with null and equal ids and as many words each, a window across two touching runs."""
    words = PASSAGE.split()
    left, right = " ".join(words[:30]), " ".join(words[30:])
    both = spark.createDataFrame([(1, left), (2, right), (2, "one")], "item_id long, text string")
    rows = [(None, PASSAGE), (None, PASSAGE), (None, " ".join(f"clean{i}" for i in range(60))), (5, left), (5, right), (5, left + " x one")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).unionByName(odd.select("doc_id", "text"))

    def found(most):
        return sorted(map(repr, decontamination.find_overlaps(docs, both, most=most).collect()))

    assert len(found(10)) == docs.count()
    assert found(10) == found(400) == found(4_000_000)


@pytest.mark.parametrize("most", [10, 4_000_000])
def test_clean_rows_without_an_id_stay(spark, items, most):
    rows = [(None, PASSAGE, 1), (None, "a clean text", 2), (None, None, 3), (5, PASSAGE, 4), (6, "another clean text", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, place int")
    kept = decontamination.clean_documents(docs, items, most=most)
    assert kept.schema == docs.schema
    assert sorted(r["place"] for r in kept.collect()) == [2, 3, 5]


def test_overlaps_are_the_same_in_parts(spark, odd, items):
    """Rows with null and equal ids and as many words each, a window across two touching runs."""
    words = PASSAGE.split()
    left, right = " ".join(words[:30]), " ".join(words[30:])
    both = spark.createDataFrame([(1, left), (2, right), (2, "one")], "item_id long, text string")
    rows = [(None, PASSAGE), (None, PASSAGE), (None, " ".join(f"clean{i}" for i in range(60))), (5, left), (5, right), (5, left + " x one")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).unionByName(odd.select("doc_id", "text"))

    def found(most):
        return sorted(map(repr, decontamination.find_overlaps(docs, both, most=most).collect()))

    assert len(found(10)) == docs.count()
    assert found(10) == found(400) == found(4_000_000)


def _brute_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = collections.Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    repeated = {j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    symbols = sum(c in quality.SYMBOLS for c in text or "")
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(repeated)


def test_quality_counts_and_verdicts(spark, odd, labels, empty):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    both = odd.select("doc_id", "text", "lang").unionByName(docs)
    rows = quality.text_counts(both).collect()
    for r in rows:
        assert tuple(r[c] for c in quality.COUNTS) == _brute_counts(r["text"]), r["doc_id"]
    judged = quality.judge(odd, labels)
    assert judged.count() == odd.count() and judged.where("kept and base_failed").count() == 0
    assert quality.judge(empty, labels).count() == 0
    assert quality.judge(odd, labels.where("false")).where("kept <> (not base_failed)").count() == 0
    assert quality.filter_documents(odd, labels).columns == odd.columns


def test_binomial_test_is_exact(spark):
    cases = [(n, k, share) for n in (1, 10, 200, 3000) for k in (0, 1, n // 100, n // 50) for share in (0.005, 0.05)]
    for n, k, share in cases:
        got = spark.range(1).select(quality.binomial_p_value(F.lit(k).cast("long"), F.lit(n).cast("long"), share)).first()[0]
        if k >= n * share:
            assert got == 1.0
        else:
            exact = sum(math.comb(n, i) * share**i * (1 - share) ** (n - i) for i in range(k + 1))
            assert got == pytest.approx(exact, rel=1e-9)


def test_cutoffs_keep_good_documents(spark):
    """Good texts with few symbols, bad ones full of them, enough labels to certify a cutoff."""
    random.seed(2)

    def text(bad):
        words = [f"{random.choice('abcdef')}{random.randint(0, 10**6)}" for _ in range(60)]
        return " ".join(w + "###" if bad and i % 2 else w for i, w in enumerate(words))

    rows = [(i, text(i % 3 == 0), "en") for i in range(6000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    marks = spark.createDataFrame([(i, 0 if i % 3 == 0 else 1) for i in range(0, 6000)], "doc_id long, quality int")
    judged = {r["doc_id"]: r["kept"] for r in quality.judge(docs, marks).collect()}
    assert all(judged[i] == (i % 3 != 0) for i in judged)


def _brute_url(url):
    if not url or "://" not in url:
        return "", ""
    host, path = re.match(r"([^/?#]*)([^?#]*)", url.split("://", 1)[1]).groups()
    return "".join(c.lower() if c.isascii() else c for c in host), path


def test_urls(spark):
    odd_urls = [None, "", "no scheme", "http://", "HTTP://WWW.Example.ORG/es/x?y#z", "http://a.com/fr/a://b.com/de/", "x://com/de", "http://xcom/de/1", LONG]
    pages = spark.createDataFrame([(i, u, "clash") for i, u in enumerate(odd_urls)], "page_id long, url string, rule string")
    pages = pages.unionByName(spark.read.parquet(f"{SF}/pages.parquet").select((F.col("page_id") + 100).alias("page_id"), "url", F.lit("").alias("rule")))
    source = {r["page_id"]: r["url"] for r in pages.collect()}
    for r in url_filter.judge_urls(pages, registry.RULES).collect():
        host, path = _brute_url(source[r["page_id"]])
        fits = [x for x in registry.RULES if (host == x.host or host.endswith("." + x.host)) and path.startswith(x.path)]
        best = max(fits, key=lambda x: len(x.prefix), default=None)
        assert (r["host"], r["path"], r["rule"]) == (host, path, best.prefix if best else None)
        assert r["verdict"] in ("allow", "block") and (best is None or r["verdict"] == best.verdict)
    assert url_filter.judge_urls(pages.where("false"), registry.RULES).count() == 0


def test_url_model_on_held_out_urls():
    random.seed(6)
    bad = lambda: f"^www.{random.choice(['cheap', 'free', 'best'])}-{random.choice(['pills', 'bets'])}{random.randint(0, 99)}.com\n/{random.randint(0, 999)}$"
    good = lambda: f"^{random.choice(['news', 'library', 'school'])}{random.randint(0, 99)}.net\n/{random.randint(0, 999)}$"
    train, test = [[(bad(), True) for _ in range(300)] + [(good(), False) for _ in range(300)] for _ in range(2)]
    model = url_filter.train(*map(list, zip(*train)))
    guess = model.probability(pa.array([u for u, _ in test])) >= 0.5
    assert (guess == np.array([b for _, b in test])).mean() > 0.97
    assert model.probability(pa.array(["", None]))[0] == pytest.approx(1 / (1 + math.exp(-model.bias)))


class _PlainText(HTMLParser):
    """Text of a page by the standard library's parser."""

    def __init__(self):
        super().__init__()
        self.parts, self.skipped = [], None

    def handle_starttag(self, tag, attrs):
        if self.skipped is None and tag in ("script", "style", "noscript", "template"):
            self.skipped = tag
        self.parts.append("\n" if tag in warc.BREAKING and self.skipped is None else "")

    def handle_endtag(self, tag):
        if tag == self.skipped:
            self.skipped = None
        elif self.skipped is None and tag in warc.BREAKING:
            self.parts.append("\n")

    def handle_data(self, data):
        if self.skipped is None:
            self.parts.append(data)


def _parsed_text(markup):
    parser = _PlainText()
    parser.feed(" ".join(markup.split()))
    parser.close()
    lines = (" ".join(line.split()) for line in "".join(parser.parts).split("\n"))
    return "\n".join(line for line in lines if line)


def test_html_text_equals_a_parser(spark):
    pages = [r["html"] or "" for r in spark.read.parquet(f"{SF}/pages.parquet").select("html").collect()]
    made = ['<p title="a > b">text</p>', '<p title = "a > b">text</p>', "<a href='x<y'>link</a> <b data-x=\"it's\">bold</b>", '<script src="a>b">no</script>yes', "<p>it's <i>so</i>"]
    for page in pages + made:
        assert warc.html_text(page) == _parsed_text(page)
    assert warc.html_text(made[0]) == "text" and warc.html_text('<p title="open>text') == "text"


def test_warc_files_hold_the_records(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet").limit(40).unionByName(
        spark.createDataFrame([(None, None, None), (-1, "http://x/", "<p>a<b>b</b> &amp; c<script>x<y</script><br>d<!-- e")], "page_id long, url string, html string")
    )
    records = warc.derive_records(warc.responses_of(pages)).collect()
    assert len(records) == 2 * 42
    folder = run_dir(spark, "warc")
    warc.write_warc(warc.derive_records(warc.responses_of(pages)).coalesce(1), folder)
    data = b"".join(bytes(r[0]) for r in spark.read.format("binaryFile").load(f"{folder}/part-*").select("content").collect())
    at, read = 0, []
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        fields = dict(line.split(": ", 1) for line in data[at:end].decode().split("\r\n")[1:])
        block = data[end + 4 : end + 4 + int(fields["Content-Length"])]
        assert data[at:].startswith(b"WARC/1.1\r\n") and warc.digest(block) == fields["WARC-Block-Digest"]
        read.append((fields["WARC-Record-ID"], fields["WARC-Refers-To"], block.decode()))
        at = end + 4 + len(block) + 4
    assert sorted(read) == sorted((r["record_id"], r["refers_to"], r["block"]) for r in records)
    by_id = {r["record_id"]: r for r in records}
    assert all(by_id[r["concurrent_to"]]["concurrent_to"] == r["record_id"] for r in records)
    small = next(r for r in records if r["source_id"] == "-1" and r["type"] == "conversion")
    assert small["block"] == "ab & c\nd"
    binary = warc.derivatives("<urn:uuid:1>", "u", warc.CAPTURED, b"HTTP/1.1 200 OK\r\nContent-Type: image/png\r\n\r\n\x89PNG")
    assert [r["type"] for r in binary] == ["metadata"] and warc.digest(b"\x89PNG") in binary[0]["block"]


# --- sharding -----------------------------------------------------------------------------------


@pytest.mark.parametrize("n", [1, 2, 3, 7, 50, 997, 1023])
def test_permutation_is_a_bijection(spark, n):
    assert sorted(r[0] for r in spark.range(n).select(sharding.permute(F.col("id"), n, 5)).collect()) == list(range(n))


def test_shards_are_level_and_reproducible(odd, empty):
    rows = [tuple(r) for r in sharding.shard(odd, 5).drop("row_number").collect()]
    assert sorted(rows, key=repr) == sorted((tuple(r) for r in sharding.shard(odd.repartition(7), 5).drop("row_number").collect()), key=repr)
    slots = collections.defaultdict(list)
    for _, size, crc, shard, slot in rows:
        slots[shard].append(slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    assert {(r[1], r[2]) for r in rows} == {(len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for t in ODD_TEXTS + ["another text under an id already used"]}
    assert sharding.shard(empty, 5).count() == 0


# --- pipeline --------------------------------------------------------------------------------------


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r["doc_id"]: r["text"] for r in docs.collect()}
        path = run_dir(spark, name)
        stage(spark, docs, SF).write.parquet(path)
        kept = spark.read.parquet(path)
        assert kept.columns == columns
        after = {r["doc_id"]: r["text"] for r in kept.collect()}
        assert set(after) <= set(before)
        if name == "quality_rules":
            assert {i for i, t in before.items() if _brute_counts(t)[0] >= 50 and 2 * _brute_counts(t)[4] <= _brute_counts(t)[0]} >= set(after)
        if name == "near_dedup":
            rows = docs.select("doc_id", "text").collect()
            firsts = {}
            for row, root in zip(rows, _brute_classes(rows)):
                firsts[root] = min(firsts.get(root, row["doc_id"]), row["doc_id"])
            assert set(after) == set(firsts.values())
        if name == "decontamination":
            bad = decontamination.find_overlaps(docs, spark.read.parquet(f"{SF}/benchmark.parquet")).where("contaminated")
            assert set(after) == set(before) - {r["doc_id"] for r in bad.collect()}
        docs = kept
    packed = corpus_pipeline.run(spark, SF).collect()
    assert {r["doc_id"] for r in packed} == {r["doc_id"] for r in docs.collect()}
    _check_packing(packed, 1024)


