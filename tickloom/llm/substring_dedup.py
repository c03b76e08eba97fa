"""Substring deduplication with fixed-block anchors.

Every text is cut into non-overlapping reference blocks of ``BLOCK`` words; a repeat of
``2 * BLOCK - 1`` = 13 words or more contains a whole block of the other text, wherever it
lies. So a hash index of blocks is probed with every rolling window of ``BLOCK`` words; what
hits an anchor is extended, window by window of 13 words, to the maximal repeats.

Texts are dealt into groups of some MB. A group sends each distinct window hash once, as
four bytes, to the index part its leading bits name, with a bit that says whether the hash
is a block there; a passage that a third of all texts share thus costs a group four bytes.
The index part answers with one bit per hash: whether it occurs in another group and is a
block in one of them. Windows of 13 words around such anchors are sent as full hashes with
the smallest document that holds them, and answered with one bit: whether a smaller document
of another group holds them. Both answers are in the order of the sorted hashes, which a
group finds again whatever the order of its rows. Texts are shuffled once, into the groups.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.words import SPACES, Words, find_words, text_bytes, whole_windows, window_hashes

WINDOW = 13
BLOCK = (WINDOW + 1) // 2
#: Hashes an index part should hold.
PART_HASHES = 1_500_000
NO_ID = np.iinfo(np.int64).max  # a null id is larger than any other

ENTRY_SCHEMA = "part int, batch long, n int, hashes binary, extra binary"
ANSWER_SCHEMA = "batch long, kind int, part int, n int, bits binary"


def plan_sizes(total_bytes: int) -> tuple[int, int]:
    """Number of text groups, and bits that number the index parts.

    Groups grow with the square root of the corpus, from 4 to 128 MB, so that the rows
    between groups and parts stay few beside the hashes they carry.
    """
    group = min(128e6, max(4e6, math.sqrt(total_bytes * 3e4)))
    parts = max(1.0, total_bytes / 6 / PART_HASHES)
    return max(1, math.ceil(total_bytes / group)), min(24, math.ceil(math.log2(parts)))


class Group:
    """The texts of one group: words, window hashes, and what the index answered."""

    def __init__(self, table: pa.Table, part_bits: int) -> None:
        self.bits = part_bits
        table = table.select(["doc_id", "text"]).combine_chunks()
        ids = table.column("doc_id").combine_chunks() if table.num_rows else pa.array([], pa.int64())
        self.doc_ids = ids.fill_null(int(NO_ID)).to_numpy(zero_copy_only=False).astype(np.int64)
        self.null_ids = ids.is_null().to_numpy(zero_copy_only=False)
        self.data, self.offsets = text_bytes(table.column("text").cast(pa.large_string()))
        self.words: Words = find_words(self.data, self.offsets, SPACES)
        self.text = self.words.text
        hashes = window_hashes(self.words.hash, BLOCK) >> np.uint64(64 - 32 - part_bits)
        self.probe_at = np.flatnonzero(whole_windows(self.words.first, BLOCK))
        self.probes = hashes[self.probe_at]
        place = self.probe_at - self.words.first[self.text[self.probe_at]]
        self.is_block = place % BLOCK == 0
        self.distinct, self.number = np.unique(self.probes, return_inverse=True)

    def parts(self, hashes: np.ndarray, drop: int) -> tuple[np.ndarray, np.ndarray]:
        """Part numbers that sorted hashes fall in, and where each begins (the end included)."""
        if not len(hashes):
            return np.zeros(0, np.int64), np.zeros(1, np.int64)
        number = (hashes >> np.uint64(drop)).astype(np.int64) if drop < 64 else np.zeros(len(hashes), np.int64)
        begin = np.flatnonzero(np.diff(number, prepend=-1))
        return number[begin], np.append(begin, len(hashes))

    def anchor_entries(self, batch: int) -> Iterator[tuple]:
        blocks = np.zeros(len(self.distinct), bool)
        blocks[self.number[self.is_block]] = True
        parts, edges = self.parts(self.distinct, 32)
        for part, a, b in zip(parts.tolist(), edges[:-1].tolist(), edges[1:].tolist()):
            low = (self.distinct[a:b] & np.uint64(0xFFFFFFFF)).astype("<u4")
            yield part, batch, b - a, low.tobytes(), np.packbits(blocks[a:b]).tobytes()

    def extend(self, anchored: np.ndarray) -> None:
        """Windows of 13 words around anchors: ``anchored`` says which distinct hashes were hit elsewhere."""
        # and those hit within the group: a block of one text and a window of another
        docs = self.doc_ids[self.text[self.probe_at]]
        low, high = _spread(self.number, docs, len(self.distinct))
        blocks = np.zeros(len(self.distinct), bool)
        blocks[self.number[self.is_block]] = True
        hit = (anchored | (blocks & (low < high)))[self.number]
        total = len(self.words.start)
        marks = np.zeros(total + 1, np.int64)
        marks[self.probe_at[hit] + 1] = 1
        marks = np.cumsum(marks)
        at = np.flatnonzero(whole_windows(self.words.first, WINDOW))
        self.windows = at[marks[np.minimum(at + WINDOW - BLOCK + 1, total)] > marks[at]]
        found = window_hashes(self.words.hash, WINDOW, seed=1)[self.windows]
        self.long, self.long_number = np.unique(found, return_inverse=True)
        self.window_docs = self.doc_ids[self.text[self.windows]]
        self.least, _ = _spread(self.long_number, self.window_docs, len(self.long))

    def window_entries(self, batch: int) -> Iterator[tuple]:
        parts, edges = self.parts(self.long, 64 - self.bits)
        for part, a, b in zip(parts.tolist(), edges[:-1].tolist(), edges[1:].tolist()):
            yield part, batch, b - a, self.long[a:b].astype("<u8").tobytes(), self.least[a:b].astype("<i8").tobytes()

    def removed(self, held_before: np.ndarray) -> np.ndarray:
        """Words covered by a window that a smaller document holds."""
        repeated = held_before[self.long_number] | (self.least[self.long_number] < self.window_docs)
        marks = np.zeros(len(self.words.start) + 1, np.int64)
        np.add.at(marks, self.windows[repeated], 1)
        np.add.at(marks, self.windows[repeated] + WINDOW, -1)
        return np.cumsum(marks[:-1]) > 0

    def without(self, gone: np.ndarray) -> pa.Table:
        """Per text: its words, how many went, and the others joined by one space."""
        keep, first = ~gone, self.words.first
        kept_before = np.concatenate([[0], np.cumsum(keep)])
        last_kept = keep & (kept_before[1:] == kept_before[first[1:]][self.text])  # no space after these
        marks = np.zeros(len(self.data) + 1, np.int8)
        marks[self.words.start[keep]] += 1
        np.add.at(marks, (self.words.end + 1 - last_kept)[keep], -1)
        taken = np.cumsum(marks[:-1], dtype=np.int8) > 0
        joined = np.where(SPACES[self.data], np.uint8(0x20), self.data)[taken]
        ends = np.concatenate([[0], np.cumsum(taken, dtype=np.int64)])[self.offsets]
        texts = pa.LargeStringArray.from_buffers(len(self.doc_ids), pa.py_buffer(ends.astype(np.int64).tobytes()), pa.py_buffer(joined.tobytes()))
        n_words = np.diff(first)
        return pa.table(
            {
                "doc_id": pa.array(self.doc_ids, pa.int64(), mask=self.null_ids),
                "n_words": pa.array(n_words, pa.int64()),
                "n_removed": pa.array(n_words - np.diff(kept_before[first]), pa.int64()),
                "text": texts.cast(pa.string()),
            }
        )


def _spread(number: np.ndarray, docs: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The smallest and largest document of each numbered hash."""
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    order = np.argsort(number, kind="stable")
    begin = np.searchsorted(number[order], np.arange(n))
    return np.minimum.reduceat(docs[order], begin), np.maximum.reduceat(docs[order], begin)


def _entries(rows: Iterator[tuple]) -> pa.Table:
    names, kinds = ["part", "batch", "n", "hashes", "extra"], [pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary()]
    columns = list(zip(*rows)) or [[]] * 5
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], names)


def _bits(answers: pa.Table, kind: int, n: int) -> np.ndarray:
    """The answers of one kind as a bit for each sorted hash; the parts follow one another."""
    rows = sorted((r for r in answers.to_pylist() if r["kind"] == kind), key=lambda r: r["part"])
    if not rows:
        return np.zeros(n, bool)
    bits = np.concatenate([np.unpackbits(np.frombuffer(r["bits"], np.uint8), count=r["n"]) for r in rows]).astype(bool)
    assert len(bits) == n, "the answers are of another group"
    return bits


def _batch(key: tuple) -> int:
    return key[0].as_py()


def _answer(kind: int):
    """What an index part says of the hashes that all groups sent it."""

    def answer(key: tuple, table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["batch"])
        sizes = np.array([r["n"] for r in rows])
        if kind == 0:
            hashes = np.concatenate([np.frombuffer(r["hashes"], "<u4") for r in rows])
            block = np.concatenate([np.unpackbits(np.frombuffer(r["extra"], np.uint8), count=r["n"]) for r in rows])
            order = np.argsort(hashes, kind="stable")
            ordered = hashes[order]
            begin = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
            count = np.diff(np.append(begin, len(ordered)))
            yes = (count > 1) & (np.add.reduceat(block[order].astype(np.int64), begin) > 0)
            found = np.empty(len(ordered), bool)
            found[order] = np.repeat(yes, count)
        else:
            hashes = np.concatenate([np.frombuffer(r["hashes"], "<u8") for r in rows])
            docs = np.concatenate([np.frombuffer(r["extra"], "<i8") for r in rows])
            order = np.argsort(hashes, kind="stable")
            ordered = hashes[order]
            begin = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
            count = np.diff(np.append(begin, len(ordered)))
            found = np.empty(len(ordered), bool)
            found[order] = docs[order] > np.repeat(np.minimum.reduceat(docs[order], begin), count)
        edges = np.cumsum(sizes)[:-1]
        return pa.table(
            {
                "batch": pa.array([r["batch"] for r in rows], pa.int64()),
                "kind": pa.array([kind] * len(rows), pa.int32()),
                "part": pa.array([r["part"] for r in rows], pa.int32()),
                "n": pa.array(sizes.tolist(), pa.int32()),
                "bits": pa.array([np.packbits(x).tobytes() for x in np.split(found, edges)], pa.binary()),
            }
        )

    return answer


def dealt(docs: DataFrame, n_groups: int) -> DataFrame:
    """doc_id and text of ``docs``, and the group of each row: rows that share an id are spread by their texts."""
    return docs.select(
        F.col("doc_id").cast("long"), F.col("text").cast("string"), F.pmod(F.xxhash64("doc_id", "text"), F.lit(n_groups)).alias("batch")
    )


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) without words that a smaller document holds in a 13-word window.

    Returns doc_id, n_words, n_removed and text, the kept words joined by one space. Windows
    are judged on the input. Null and empty texts have no words; rows with equal ids are no
    smaller than one another and don't take each other's words; a null id is larger than any
    other; no rows give no rows; other columns are ignored. Windows count as equal if 64-bit
    hashes of their 13 words are, after their anchors matched by other hashes.
    """
    total = docs.agg(F.sum(F.octet_length("text")).alias("bytes")).first()["bytes"] or 0
    n_groups, part_bits = plan_sizes(total)
    rows = dealt(docs, n_groups)

    def send_anchors(key: tuple, table: pa.Table) -> pa.Table:
        return _entries(Group(table, part_bits).anchor_entries(_batch(key)))

    def send_windows(key: tuple, table: pa.Table, answers: pa.Table) -> pa.Table:
        group = Group(table, part_bits)
        group.extend(_bits(answers, 0, len(group.distinct)))
        return _entries(group.window_entries(_batch(key)))

    def finish(key: tuple, table: pa.Table, answers: pa.Table) -> pa.Table:
        group = Group(table, part_bits)
        group.extend(_bits(answers, 0, len(group.distinct)))
        return group.without(group.removed(_bits(answers, 1, len(group.long))))

    groups = rows.groupBy("batch")
    anchors = groups.applyInArrow(send_anchors, ENTRY_SCHEMA).groupBy("part").applyInArrow(_answer(0), ANSWER_SCHEMA)
    windows = groups.cogroup(anchors.groupBy("batch")).applyInArrow(send_windows, ENTRY_SCHEMA)
    held = windows.groupBy("part").applyInArrow(_answer(1), ANSWER_SCHEMA)
    answers = anchors.unionByName(held)
    result = groups.cogroup(answers.groupBy("batch")).applyInArrow(finish, "doc_id long, n_words long, n_removed long, text string")
    return result


REPEAT_SQL = r"""
WITH doc_words AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), windows AS (
    SELECT doc_id, i, array_to_string(words[i:i + 12], ' ') AS key
    FROM (SELECT doc_id, words, unnest(range(1, greatest(0, length(words) - 12) + 1)) AS i FROM doc_words)
), firsts AS (SELECT key, min(doc_id) AS least FROM windows GROUP BY key HAVING min(doc_id) < max(doc_id)
), gone AS (
    SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS place FROM windows JOIN firsts USING (key) WHERE least < doc_id
), placed AS (
    SELECT doc_id, unnest(words) AS word, unnest(range(1, length(words) + 1)) AS place FROM doc_words
), kept AS (
    SELECT doc_id, string_agg(word, ' ' ORDER BY place) AS text, count(*) AS n
    FROM placed ANTI JOIN gone USING (doc_id, place) GROUP BY doc_id
)
SELECT d.doc_id, length(words)::BIGINT AS n_words, (length(words) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM doc_words AS d LEFT JOIN kept USING (doc_id)
"""
