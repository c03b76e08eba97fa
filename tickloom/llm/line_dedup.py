"""Corpus-wide line deduplication, in DataFrame functions only.

Long lines become (key hash, document, position) rows. The hashes are range-partitioned
and sorted by document and position within, so each key's lines stream past in order: the
first document met (the largest id) keeps its lines, the others lose theirs. What travels
back is a bitmap per document, not text: 64 lines to a word, words in which every line
stays are left out.

A key can't be cut across range partitions, so keys with more than one row in
``HOT_SHARE`` (estimated on a sample, which decides on the route only) go by a route of
partial aggregates instead, and leave the range partitions level.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tickloom.llm.common import WHITE_SPACE, ascii_lower, bind, materialise

HOT_SHARE = 2000
SAMPLE_ROWS = 2_000_000
KEY = ["h1", "h2"]
ADDED = ["n_lines", "n_dropped", "row_key", "_map_doc", "_map_key", "_map_keep"]


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def line_rows(docs: DataFrame, min_chars: int) -> DataFrame:
    """One row for each line whose key has ``min_chars`` code points: 96 bits of hash, document, position."""
    exploded = docs.select(
        "doc_id", F.xxhash64("text").alias("row_key"), F.posexplode(_lines(F.col("text"))).alias("pos", "line")
    )
    key = F.btrim("line", F.lit(WHITE_SPACE))
    return (
        exploded.where(F.char_length("line") >= min_chars)
        .withColumn("key", ascii_lower(key))
        .where(F.char_length("key") >= min_chars)
        .select(F.xxhash64("key").alias("h1"), F.hash("key").alias("h2"), "doc_id", "row_key", "pos")
    )


def hot_keys(lines: DataFrame) -> DataFrame:
    """Keys with about one row in ``HOT_SHARE`` or more; some ``2 * HOT_SHARE`` keys at the most."""
    total = lines.count()
    share = min(1.0, SAMPLE_ROWS / max(total, 1))
    sampled = lines.select(*KEY) if share == 1.0 else lines.select(*KEY).sample(share, 7)
    least = max(64, int(total * share / HOT_SHARE))
    return sampled.groupBy(*KEY).count().where(F.col("count") >= least).select(*KEY)


def dropped_lines(lines: DataFrame, min_docs: int) -> DataFrame:
    """(doc_id, row_key, pos) of lines to drop: of keys in ``min_docs`` documents, all but the largest id's."""
    hot = materialise(hot_keys(lines), "hot-lines")
    cold = lines.join(F.broadcast(hot), KEY, "left_anti").repartitionByRange(*[F.col(c) for c in KEY])
    in_key = W.partitionBy(*KEY)
    in_order = in_key.orderBy(F.col("doc_id").desc_nulls_last(), "pos")
    other = (F.row_number().over(in_order) == 1) | ~F.lag("doc_id").over(in_order).eqNullSafe(F.col("doc_id"))
    streamed = (
        cold.withColumn("new_doc", other.cast("int"))
        .withColumn("rank", F.sum("new_doc").over(in_order.rowsBetween(W.unboundedPreceding, 0)))
        .withColumn("n_docs", F.sum("new_doc").over(in_key))
        .where((F.col("n_docs") >= min_docs) & (F.col("rank") > 1))
    )
    hot_lines = lines.join(F.broadcast(hot), KEY, "left_semi")
    holders = (
        hot_lines.select(*KEY, "doc_id")
        .distinct()
        .groupBy(*KEY)
        .agg(F.count("*").alias("n_docs"), F.max("doc_id").alias("last_doc"))
        .where(F.col("n_docs") >= min_docs)
    )
    summed = hot_lines.join(F.broadcast(holders), KEY).where(~F.col("doc_id").eqNullSafe(F.col("last_doc")))
    where = ["doc_id", "row_key", "pos"]
    return streamed.select(*where).unionByName(summed.select(*where))


def keep_bitmaps(docs: DataFrame, min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """Which lines of ``docs`` (doc_id, text) stay, for documents that lose some.

    Returns doc_id, row_key (a hash of the text: rows that share an id but not their text
    have bitmaps of their own), n_dropped, and keep, a list of (word, bits) in order: bit
    ``i`` of ``bits`` says if line ``64 * word + i`` stays; lines of words not listed stay.
    """
    lines = materialise(line_rows(docs.select("doc_id", "text"), min_chars), "lines")
    bit = F.expr("shiftleft(1L, pos % 64)")
    words = (
        dropped_lines(lines, min_docs)
        .withColumn("word", F.floor(F.col("pos") / 64).cast("int"))
        .groupBy("doc_id", "row_key", "word")
        .agg(F.bit_or(bit).alias("dropped"))
    )
    return words.groupBy("doc_id", "row_key").agg(
        F.sum(F.bit_count("dropped")).cast("long").alias("n_dropped"),
        F.array_sort(F.collect_list(F.struct("word", F.bitwise_not("dropped").alias("bits")))).alias("keep"),
    )


def _kept(text: Column, keep: Column) -> Column:
    def gap(entry: Column, i: Column) -> Column:
        before = F.coalesce(F.get(keep, i - 1)["word"], F.lit(-1))
        return F.concat(F.array_repeat(F.lit(-1).cast("long"), entry["word"] - before - 1), F.array(entry["bits"]))

    def stays(words: Column, i: Column) -> Column:
        word = F.get(words, F.floor(i / 64).cast("int"))
        return word.isNull() | (F.call_function("shiftright", word, i % 64).bitwiseAND(F.lit(1)) == 1)

    def joined(words: Column) -> Column:
        return bind(_lines(text), lambda lines: F.array_join(F.filter(lines, lambda _, i: stays(words, i)), "\n"))

    return bind(F.flatten(F.transform(keep, gap)), joined)


def dedup_lines(docs: DataFrame, min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """All rows and columns of ``docs`` (doc_id, text, ...) with text less its repeated lines.

    A line's key is the line without white space at its ends and with A-Z in lower case.
    Keys of at least ``min_chars`` code points in at least ``min_docs`` documents lose their
    lines everywhere but in the largest doc_id. Added: n_lines before, n_dropped. A null text
    is one empty line; a null id is one more document, which never is the largest; rows with
    equal ids are one document; a document that loses all its lines has an empty text.
    Columns named as in ``ADDED`` are replaced or removed, others pass through.
    """
    inner = docs.drop(*ADDED).withColumn("row_key", F.xxhash64("text"))
    maps = keep_bitmaps(docs, min_chars, min_docs).select(
        F.col("doc_id").alias("_map_doc"), F.col("row_key").alias("_map_key"), F.col("n_dropped"), F.col("keep").alias("_map_keep")
    )
    same = inner["doc_id"].eqNullSafe(maps["_map_doc"]) & (inner["row_key"] == maps["_map_key"])
    text = F.when(F.col("_map_keep").isNull(), F.coalesce("text", F.lit(""))).otherwise(_kept(F.col("text"), F.col("_map_keep")))
    return (
        inner.join(maps, same, "left")
        .withColumn("n_lines", F.size(_lines(F.col("text"))).cast("long"))
        .withColumn("n_dropped", F.coalesce("n_dropped", F.lit(0).cast("long")))
        .withColumn("text", text)
        .drop("_map_doc", "_map_key", "_map_keep", "row_key")
    )


LINE_SQL = r"""
WITH lines AS (
    SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
        unnest(range(length(string_split(coalesce(text, ''), chr(10))))) AS pos
    FROM documents
), keyed AS (
    SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM lines
), shared AS (
    SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5
), judged AS (
    SELECT k.*, s.keeper IS NOT NULL AND s.keeper <> k.doc_id AS goes FROM keyed AS k LEFT JOIN shared AS s USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (goes) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT goes), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""
