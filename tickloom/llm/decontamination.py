"""Benchmark decontamination: one Aho-Corasick automaton over the benchmark's word windows.

Texts are normalised to lower-case words; every window of ``window`` words of a benchmark
item (or the whole item, if shorter) is a key of the automaton, as a sequence of word
numbers. A document's words run through it once; hits are mapped back to places in the
original text. Only the benchmark is broadcast, and its size is checked: beyond
``MAX_BENCHMARK_BYTES`` of text it is cut into parts, and each task scans its rows, some
``CHUNK_BYTES`` of text at a time, with the automaton of one part after the other. A worker holds
one automaton, the last one it used. The parts pass through the driver one by one.
"""

from __future__ import annotations

import re
import sys
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.llm.words import LOWER, NOT_ALPHANUMERIC

WINDOW = 10
#: Benchmark text in one automaton; some 150 bytes of memory for each byte of it.
MAX_BENCHMARK_BYTES = 4_000_000
#: Text a task holds while it scans with several automata, each built once for that much text.
CHUNK_BYTES = 64_000_000
#: Words come apart at every byte that becomes a space here.
NORMAL = bytes(32 if NOT_ALPHANUMERIC[b] else int(LOWER[b]) for b in range(256))
WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")

SCHEMA = T.StructType(
    [
        T.StructField("row", T.LongType()),
        T.StructField("n_words", T.LongType()),
        T.StructField("hits", T.ArrayType(T.StructType([T.StructField("first", T.IntegerType()), T.StructField("last", T.IntegerType())]))),
        T.StructField("spans", T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))),
        T.StructField("items", T.ArrayType(T.StringType())),
    ]
)


def normal_words(text: bytes | None) -> list[bytes]:
    return text.translate(NORMAL).split() if text else []


class Matcher:
    """The automaton of some items: (item id, words) pairs."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int) -> None:
        import ahocorasick

        self.items = [name for name, _ in items]
        self.numbers: dict[bytes, int] = {}
        holders: dict[tuple[int, ...], set[int]] = {}
        for place, (_, words) in enumerate(items):
            ids = tuple(self.numbers.setdefault(w, len(self.numbers) + 1) for w in words)
            for start in range(max(1, len(ids) - window + 1) if ids else 0):
                holders.setdefault(ids[start : start + window], set()).add(place)
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        for key, places in holders.items():
            self.automaton.add_word(key, (len(key), tuple(places)))
        self.shortest = min(map(len, holders), default=0)
        if holders:
            self.automaton.make_automaton()

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], list[str]]:
        """Merged runs (first word, last word) covered by windows, and the items they come from."""
        runs: list[tuple[int, int]] = []
        found: set[int] = set()
        if not self.shortest or len(words) < self.shortest:
            return runs, []
        get = self.numbers.get
        for last, (size, places) in self.automaton.iter(tuple([get(w, 0) for w in words])):
            first = last - size + 1
            found.update(places)
            while runs and first <= runs[-1][1] + 1:
                first = min(first, runs.pop()[0])
            runs.append((first, last))
        return runs, sorted({self.items[i] for i in found})


def _matcher(name: str, part: Broadcast, window: int) -> Matcher:
    """The automaton of ``part``, kept in the worker until it needs another one."""
    kept = vars(sys).setdefault("_corpus_matcher", {})
    if name not in kept:
        kept.clear()
        kept[name] = Matcher([(item, normal_words(text)) for item, text in part.value], window)
        vars(part).pop("_value", None)  # the part's text; it is read again if needed
    return kept[name]


def _chunks(batches: Iterator[pa.RecordBatch], text: str, most: int) -> Iterator[list[pa.RecordBatch]]:
    """Batches in lists of ``most`` bytes of text, a batch at least."""
    chunk: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        chunk.append(batch)
        size += pc.sum(pc.binary_length(batch.column(text))).as_py() or 0
        if size >= most:
            yield chunk
            chunk, size = [], 0
    if chunk:
        yield chunk


def united(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Runs that overlap or touch as one."""
    done: list[tuple[int, int]] = []
    for first, last in sorted(runs):
        if done and first <= done[-1][1] + 1:
            done[-1] = (done[-1][0], max(done[-1][1], last))
        else:
            done.append((first, last))
    return done


def _scanned(parts: list[Broadcast], window: int, text: str):
    """A function from batches to (batch, its rows' bytes of text, number of words, runs and items), whatever the number of parts."""
    token = uuid.uuid4().hex  # names these automata in worker processes that several queries use

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[list]]]:
        for chunk in _chunks(batches, text, CHUNK_BYTES if len(parts) > 1 else 0):
            rows = [[[value.as_py(), 0, [], []] for value in batch.column(text).cast(pa.binary())] for batch in chunk]
            for k, part in enumerate(parts):
                matcher = _matcher(f"{token}-{k}", part, window)
                for held in rows:
                    for row in held:
                        words = normal_words(row[0])
                        row[1] = len(words)
                        runs, items = matcher.scan(words)
                        row[2] += runs
                        row[3] += items
                del matcher  # before the next one is built
            for batch, held in zip(chunk, rows):
                for row in held:
                    if row[2]:
                        row[2:] = united(row[2]), sorted(set(row[3]))
                yield batch, held

    return scan


def _scanner(parts: list[Broadcast], window: int):
    scanned = _scanned(parts, window, "content")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [
                ("row", pa.int64()),
                ("n_words", pa.int64()),
                ("hits", pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))),
                ("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
                ("items", pa.list_(pa.string())),
            ]
        )
        for batch, found in scanned(batches):
            rows = []
            for row, (text, n_words, runs, items) in zip(batch.column("row"), found):
                spans = []
                if runs:
                    places = [m.span() for m in WORD.finditer(text.decode("utf-8", "replace"))]
                    spans = [{"start": places[a][0], "end": places[b][1]} for a, b in runs]
                hits = [{"first": a, "last": b} for a, b in runs]
                rows.append({"row": row.as_py(), "n_words": n_words, "hits": hits, "spans": spans, "items": items})
            yield pa.RecordBatch.from_pylist(rows, schema)

    return scan


def _broadcast(spark: SparkSession, benchmark: DataFrame, most: int) -> list[Broadcast]:
    context = spark.sparkContext
    return [context.broadcast(part) for part in benchmark_parts(benchmark, most)] or [context.broadcast([])]


def benchmark_parts(benchmark: DataFrame, most: int = MAX_BENCHMARK_BYTES) -> Iterator[list[tuple[str, bytes]]]:
    """The benchmark's (item_id, text) rows in parts of ``most`` bytes of text, an item at least."""
    part: list[tuple[str, bytes]] = []
    size = 0
    rows = benchmark.select(F.col("item_id").cast("string"), F.col("text").cast("binary")).where("text IS NOT NULL")
    for name, text in rows.toLocalIterator():
        if part and size + len(text) > most:
            yield part
            part, size = [], 0
        part.append((name if name is not None else "", bytes(text)))
        size += len(text)
    if part:
        yield part


def find_overlaps(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, most: int = MAX_BENCHMARK_BYTES) -> DataFrame:
    """Overlaps of every row of ``docs`` (doc_id, text) with ``benchmark`` (item_id, text).

    Returns doc_id, n_words, n_hit (words inside an occurrence of a window), n_items,
    item_ids (sorted as strings), contaminated, and spans: (start, end) in code points of the
    original text. Null and empty texts have no words; items without words match nothing; an
    item id that is null counts as the empty string; repeated rows are judged alike; an empty
    benchmark contaminates nothing. Other columns are ignored. Texts are scanned where they
    are read, without a shuffle, into one row for each, however many parts the benchmark needs.
    """
    return _overlaps(docs, _broadcast(docs.sparkSession, benchmark, most), window)


def _overlaps(docs: DataFrame, parts: list[Broadcast], window: int) -> DataFrame:
    texts = docs.select(F.col("doc_id").cast("long").alias("row"), F.col("text").cast("binary").alias("content"))
    found = texts.mapInArrow(_scanner(parts, window), SCHEMA)
    covered = F.aggregate("hits", F.lit(0).cast("long"), lambda total, run: total + run["last"] - run["first"] + 1)
    return found.select(
        F.col("row").alias("doc_id"),
        "n_words",
        covered.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.col("items").alias("item_ids"),
        (F.size("hits") > 0).alias("contaminated"),
        "spans",
    )


def uncontaminated_rows(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, most: int = MAX_BENCHMARK_BYTES) -> DataFrame:
    """The rows and columns of ``docs`` (text) whose own text has no window of the benchmark.

    Each row is judged by itself, whatever its id, where it is read: nothing is shuffled. Null
    and empty texts stay, an empty benchmark keeps all.
    """
    scanned = _scanned(_broadcast(docs.sparkSession, benchmark, most), window, "text")

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, found in scanned(batches):
            yield batch.filter(pa.array([not runs for _, _, runs, _ in found], pa.bool_()))

    return docs.mapInArrow(clean, docs.schema)


def clean_documents(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, most: int = MAX_BENCHMARK_BYTES) -> DataFrame:
    """The rows and columns of ``docs`` whose text has no window of the benchmark.

    Rows that share an id share the verdict; rows without an id are judged by their own text.
    """
    parts = _broadcast(docs.sparkSession, benchmark, most)
    number = F.col("doc_id").cast("long")
    named = docs.where(number.isNotNull())
    bad = _overlaps(named, parts, window).where("contaminated").select(F.col("doc_id").alias("_bad_doc")).distinct()
    scanned = _scanned(parts, window, "text")

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, found in scanned(batches):
            yield batch.filter(pa.array([not runs for _, _, runs, _ in found], pa.bool_()))

    kept = named.join(bad, number == F.col("_bad_doc"), "left_anti")
    return kept.unionByName(docs.where(number.isNull()).mapInArrow(clean, docs.schema))


OVERLAP_SQL = r"""
WITH doc_words AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
    FROM documents
), item_words AS (
    SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
    FROM benchmark
), keys AS (
    SELECT DISTINCT item_id, array_to_string(words[i:i + least(10, length(words)) - 1], ' ') AS key, least(10, length(words)) AS size
    FROM (SELECT item_id, words, unnest(range(1, greatest(1, length(words) - 9) + 1)) AS i FROM item_words WHERE length(words) > 0)
), sizes AS (SELECT DISTINCT size FROM keys
), doc_windows AS (
    SELECT doc_id, i, size, array_to_string(words[i:i + size - 1], ' ') AS key
    FROM (SELECT doc_id, words, size, unnest(range(1, greatest(0, length(words) - size + 1) + 1)) AS i FROM doc_words, sizes)
), found AS (SELECT doc_id, i, size, item_id FROM doc_windows JOIN keys USING (size, key)
), hit AS (
    SELECT doc_id, count(DISTINCT place) AS n_hit
    FROM (SELECT doc_id, unnest(range(i, i + size)) AS place FROM (SELECT DISTINCT doc_id, i, size FROM found)) GROUP BY doc_id
), items AS (
    SELECT doc_id, count(*) AS n_items, string_agg(name, ',' ORDER BY name) AS names
    FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS name FROM found) GROUP BY doc_id
)
SELECT d.doc_id, length(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
    sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc_words AS d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""
