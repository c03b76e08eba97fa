"""Contracts that rows which repeat, share an id or look special must not break; large groups of texts a little too unlike."""

import collections
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from conftest import SF

import corpus_pipeline
from tickloom.llm import near_dedup, packing, quality, registry, sharding, token_file, tokens
from tickloom.session import run_dir

BYTE_BPE, WORD_BPE = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
SPECIAL = ["a <|endoftext|> b", "<|endoftext|>", "x<|startoftext|>y z", "<|ENDOFTEXT|> up", "plain words, here.", None, "two  spaces <|endoftext|>\n\n", "half <|endof text|>"]


def _plain_tokenizer_rows(path, texts, end):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    return [[*tokenizer.encode(t or "", add_special_tokens=False).ids, end] for t in texts]


@pytest.fixture(scope="module")
def special(spark):
    return spark.createDataFrame(list(enumerate(SPECIAL)), "doc_id long, text string")


def test_token_files_hold_the_ids_of_a_plain_tokenizer(spark, special):
    folder = run_dir(spark, "tokens")
    token_file.write_token_files(special, WORD_BPE, 1, folder, special=True)
    got = {r["doc_id"]: (r["start"], r["n_tokens"], r["ids_crc32"]) for r in token_file.read_documents(spark, folder).collect()}
    at = 0
    for i, ids in enumerate(_plain_tokenizer_rows(WORD_BPE, SPECIAL, 1)):
        assert got[i] == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())), SPECIAL[i]
        at += len(ids)
    assert 49407 in _plain_tokenizer_rows(WORD_BPE, SPECIAL, 1)[0]


def test_packed_pieces_hold_the_ids_of_a_plain_tokenizer(special):
    got = {r["doc_id"]: (r["length"], r["ids_crc32"]) for r in packing.pack_documents(special, BYTE_BPE, 2, special=True).collect()}
    for i, ids in enumerate(_plain_tokenizer_rows(BYTE_BPE, SPECIAL, 2)):
        assert got[i] == (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())), SPECIAL[i]
    assert 50256 in _plain_tokenizer_rows(BYTE_BPE, SPECIAL, 2)[0]


def test_the_queries_use_the_library_default(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    packed = {(r["doc_id"], r["piece"]): r["length"] for r in registry.op2_grouping_packing(spark, SF).collect()}
    filed = {r["doc_id"]: r["n_tokens"] for r in registry.op9_token_files(spark, SF).collect()}
    assert {i: len(ids) for i, ids in zip(texts, _plain_tokenizer_rows(WORD_BPE, texts.values(), 1))} == filed
    totals = collections.Counter()
    for (i, _), length in packed.items():
        totals[i] += length
    assert totals == {i: len(ids) for i, ids in zip(texts, _plain_tokenizer_rows(BYTE_BPE, texts.values(), 2))}


@pytest.mark.parametrize("path", [BYTE_BPE, WORD_BPE])
def test_forgotten_words_keep_their_ids(monkeypatch, path):
    import pyarrow as pa

    monkeypatch.setattr(tokens, "CACHE_WORDS", 200)
    encoder, rng = tokens.WordEncoder(path, special=True), random.Random(3)
    for _ in range(30):
        texts = [" ".join(rng.choice(["the", "common,", f"rare{rng.randrange(10**6)}", "é."]) for _ in range(40)) for _ in range(3)]
        ids, counts = encoder.encode(pa.array(texts))
        expected = [ids[:-1] for ids in _plain_tokenizer_rows(path, texts, 0)]
        assert ids.tolist() == sum(expected, []) and counts.tolist() == [len(x) for x in expected]


def test_repeated_rows_change_no_cutoff(spark):
    random.seed(2)
    text = lambda bad: " ".join(f"{random.choice('abcdef')}{random.randint(0, 10**6)}" + ("###" if bad and i % 2 else "") for i in range(60))
    rows = [(i, text(i % 3 == 0), "en") for i in range(54)]
    marks = spark.createDataFrame([(i, 0 if i % 3 == 0 else 1) for i in range(54)], "doc_id long, quality int")
    docs = spark.createDataFrame(rows * 40, "doc_id long, text string, lang string")
    judged = quality.judge(docs, marks)
    assert judged.count() == len(rows) * 40
    assert judged.where("kept <> (not base_failed)").count() == 0  # 36 good documents certify nothing, however often they repeat
    assert quality.filter_documents(docs, marks).count() == judged.where("kept").count()


def test_the_pipeline_keeps_clean_rows_that_share_an_id(spark, tmp_path):
    passage = " ".join(f"item{i}" for i in range(30))
    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    unlike = [" ".join(f"{name}{i}" for i in range(60)) for name in "abc"]
    rows = [(1, unlike[0]), (1, unlike[1]), (None, unlike[2]), (1, "x " + passage), (None, passage), (2, unlike[0] + " more"), (None, None), (1, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = {r["text"] for r in corpus_pipeline.near_dedup_stage(spark, docs, str(tmp_path)).collect()}
    assert kept == {*unlike, "x " + passage, None, ""} or kept == {*unlike, passage, None, ""}
    clean = corpus_pipeline.decontaminate(spark, docs, str(tmp_path))
    assert clean.columns == docs.columns
    assert collections.Counter(r["text"] for r in clean.collect()) == collections.Counter(t for _, t in rows if passage not in (t or ""))


def _edited(rng, source, step, changes, name):
    words = list(source)
    for at in rng.sample(range(step, len(words) - step, step), changes):
        words[at] = f"{name}x{at}"
    return words


def test_links_amid_thousands_of_texts_a_little_too_unlike(spark, monkeypatch):
    """Copies some 0.66 alike, among them pairs of near copies; rows compared stay in proportion to the texts."""
    rng = random.Random(12)
    source = [f"w{i}" for i in range(300)]
    texts, near = [], []
    for i in range(5000):
        words = _edited(rng, source, 6, 6, f"own{i}")
        texts.append(" ".join(words))
        if i % 50 == 0:
            words[rng.choice(range(3, 294, 6))] = f"near{i}"
            near.append((len(texts) - 1, len(texts)))
            texts.append(" ".join(words))
    asked = []
    written = near_dedup.materialise

    def counted(df, name):
        out = written(df, name)
        if name in ("pairs", "links"):
            asked.append(out.count())
        return out

    monkeypatch.setattr(near_dedup, "materialise", counted)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = {r["doc_id"]: r["class_id"] for r in near_dedup.near_duplicates(docs).collect()}
    assert all(got[b] == a == got[a] for a, b in near)
    assert len(set(got.values())) == 5000
    assert sum(asked) < 30 * len(texts)


@pytest.mark.parametrize("slice_rows", [1000, 7])
def test_cells_link_what_brute_force_links(spark, monkeypatch, slice_rows):
    """One bucket of texts around the threshold, some in components already, in one cell and in many."""
    monkeypatch.setattr(near_dedup, "SLICE_ROWS", slice_rows)
    rng = random.Random(5)
    sources = [[f"{c}{i % 90}" for i in range(120)] for c in "abc"]  # words, and shingles, that repeat
    texts = [" ".join(_edited(rng, rng.choice(sources), 5, rng.randint(0, 4), f"own{i}")) for i in range(60)] + ["", "one two"]
    component = [i - i % 2 if i < 20 else i for i in range(len(texts))]
    rows = [(9, i, len(t), 100, component[i], 0) for i, t in enumerate(texts)]
    placed = spark.createDataFrame(rows, "bucket long, node long, n_bytes long, n_shingles long, component long, largest long")
    held = spark.createDataFrame(list(enumerate(texts)), "node long, text string")
    links = [(r["a"], r["b"]) for r in near_dedup._cell_links(placed, held, 0.8).collect()]
    sets = [near_dedup._multiset(t) for t in texts]
    alike = [(a, b) for a in range(len(texts)) for b in range(a) if near_dedup.weighted_jaccard(sets[a], sets[b]) >= 0.8]
    assert len(alike) > 50 and {(max(p), min(p)) for p in links} <= set(alike)

    def classes(pairs):
        label = list(component)
        while True:
            before = list(label)
            for a, b in [*pairs, *((i, c) for i, c in enumerate(component))]:
                label[a] = label[b] = min(label[a], label[b])
            if label == before:
                return label

    assert classes(links) == classes(alike)
    if slice_rows > len(texts):
        assert len(links) < len(set(component))


def test_equal_rows_are_counted_numbered_and_written_out(spark, monkeypatch):
    """A third of the rows equal, more than one chunk of them: slots without gaps, the same ones in any partitioning."""
    monkeypatch.setattr(sharding, "CHUNK", 7)
    rows = [(None, "")] * 100 + [(3, "a")] * 7 + [(3, None)] * 8 + [(i, f"text {i}") for i in range(185)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = [sorted(map(tuple, sharding.shard(docs.repartition(n), 8).collect()), key=str) for n in (1, 5)]
    assert got[0] == got[1] and len(got[0]) == len(rows)
    assert sorted(r[3] for r in got[0]) == list(range(len(rows)))
    slots = collections.defaultdict(list)
    for r in got[0]:
        slots[r[4]].append(r[5])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    held = collections.Counter((i, len((t or "").encode()) + 16) for i, t in rows)
    assert collections.Counter((r[0], r[1]) for r in got[0]) == held
