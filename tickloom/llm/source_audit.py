"""How sources differ in the words they use: exact comparison of smoothed term shares.

Terms are counted where the texts are read, by (lang, source, term). What a term is worth in a
group depends on two numbers only, its count in the group and its count in the language. So
terms are grouped into cells of these; the value is computed once per cell, equal values merge,
and cells are ranked by their values until the terms they hold reach the wanted ranks. Only the
cells so chosen are expanded into terms, in UTF-8 order.

Sources of a language are compared over blocks of terms: each block sums the differences of every
two sources over its terms, so a pair leaves a block as one sum, whatever the number of terms.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tickloom.llm.common import materialise

LEAST_DOCUMENTS = 30
RANKS = 50
SMOOTHING = 5
#: Distinct terms that a task counts before it passes them on.
HELD_TERMS = 400_000
#: Counts in a block of terms.
BLOCK = 100_000
#: Sources whose shares are compared at once.
SOURCES = 64

COUNTS = "lang string, source string, term string, n long, docs long"
#: Letters, in lower case, and whatever lies beyond ASCII; all else parts terms.
LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[tuple[str, str], tuple[Counter, Counter]] = {}

    def counted() -> Iterator[pa.RecordBatch]:
        for (lang, source), (times, docs) in held.items():
            if not times:
                continue
            terms = pa.array(times.keys(), pa.binary()).cast(pa.string())
            constant = [pa.array([x], pa.string()).take(pa.array(np.zeros(len(times), np.int64))) for x in (lang, source)]
            n_docs = pa.array(map(docs.__getitem__, times), pa.int64())
            yield pa.RecordBatch.from_arrays([*constant, terms, pa.array(times.values(), pa.int64()), n_docs], ["lang", "source", "term", "n", "docs"])
        held.clear()

    seen = 0
    for batch in batches:
        langs, sources = batch.column("lang").to_pylist(), batch.column("source").to_pylist()
        for lang, source, text in zip(langs, sources, batch.column("text").cast(pa.binary())):
            words = text.as_py().translate(LETTERS).split()
            times, docs = held.setdefault((lang, source), (Counter(), Counter()))
            before = len(times)
            times.update(words)
            docs.update(set(words))
            seen += len(times) - before
            if seen >= HELD_TERMS:
                yield from counted()
                seen = 0
    yield from counted()


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents; null text, lang and source are empty."""
    rows = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    partial = rows.mapInArrow(_count, COUNTS)
    return partial.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def per_billion(part: Column, whole: Column) -> Column:
    """floor(10**9 * part / whole) in whole numbers, exact while 1000 * whole fits 64 bits; part is at most whole."""
    call = lambda f, *x: F.call_function(f, *x)
    total, rest = call("div", part, whole), part % whole
    for _ in range(3):
        total, rest = total * 1000 + call("div", rest * 1000, whole), (rest * 1000) % whole
    return total


def share(count: Column, of: Column) -> Column:
    """p of a count in a group of smoothed size ``of``."""
    return per_billion(count + SMOOTHING, of) + 1


def _sums(rows: pa.Table) -> pa.Table:
    """For one block of terms, the sum over its terms of abs(p - q), for every two sources of the language."""
    lang = rows.column("lang")[0]
    is_group = pc.is_null(rows.column("term"))
    groups, entries = rows.filter(is_group), rows.filter(pc.invert(is_group))
    names = groups.column("source").combine_chunks()
    base = groups.column("p").to_numpy()
    at = pc.index_in(entries.column("source").combine_chunks(), names).to_numpy(zero_copy_only=False)
    coded = entries.column("term").combine_chunks().dictionary_encode()
    terms = coded.indices.to_numpy(zero_copy_only=False)
    p = entries.column("p").to_numpy()
    n_terms = len(coded.dictionary)
    out = []
    for first in range(0, len(base), SOURCES):
        mine = _dense(base[first : first + SOURCES], at - first, terms, p, n_terms)
        for second in range(0, len(base), SOURCES):
            other = _dense(base[second : second + SOURCES], at - second, terms, p, n_terms)
            for k, row in enumerate(mine):
                sums = np.abs(other - row).sum(axis=1)
                items = names.slice(second, len(sums))
                out.append((names.slice(first + k, 1).take(pa.array(np.zeros(len(sums), np.int64))), items, sums))
    source, item, value = zip(*out)
    source, item, value = pa.concat_arrays(source), pa.concat_arrays(item), pa.array(np.concatenate(value))
    langs = pa.array([lang.as_py()], pa.string()).take(pa.array(np.zeros(len(value), np.int64)))
    return pa.table([langs, source, item, value], ["lang", "source", "item", "value"])


def _dense(base: np.ndarray, at: np.ndarray, terms: np.ndarray, p: np.ndarray, n_terms: int) -> np.ndarray:
    """p of some sources (rows) and all terms of a block; ``base`` where a source lacks the term."""
    out = np.repeat(base[:, None], n_terms, axis=1)
    here = (at >= 0) & (at < len(base))
    out[at[here], terms[here]] = p[here]
    return out


def _first(rows: DataFrame, keys: list[str], *order: Column) -> Column:
    return F.row_number().over(W.partitionBy(*keys).orderBy(*order))


def audit_sources(docs: DataFrame, least_documents: int = LEAST_DOCUMENTS, ranks: int = RANKS) -> DataFrame:
    """How each (lang, source) group differs from the other sources and from its language.

    ``docs`` has text, lang and source; null is the empty string. Returns lang, source, part,
    item, value, rank. Part ``pair``: each other source of the language by the sum of
    differences over all kept terms (0 if there are none). Part ``term``: the first ``ranks`` terms
    that the group uses more than its language. Kept terms occur in ``least_documents``
    documents of the language. Rows without terms make a group all the same; repeated rows
    count each time; no rows give no rows; a language of one source has no pairs; other columns are
    ignored. Ties go by the item's UTF-8 bytes.
    """
    counts = materialise(term_counts(docs), "term-counts")
    of_lang = counts.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs")).where(F.col("docs") >= least_documents)
    kept = materialise(of_lang.select("lang", "term", "lang_n"), "kept-terms")
    used = materialise(counts.select("lang", "source", "term", "n").join(kept, ["lang", "term"]), "used-terms")

    langs = kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("lang_n").alias("lang_total"))
    totals = used.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count("*").alias("n_used"))
    empty = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    groups = docs.select(empty("lang"), empty("source")).distinct().join(langs, "lang", "left").join(totals, ["lang", "source"], "left").na.fill(0)
    size = lambda total: (F.col(total) + SMOOTHING * F.col("v"))
    groups = materialise(groups.select("lang", "source", "v", "n_used", size("total").alias("size"), size("lang_total").alias("lang_size")), "source-groups")

    sized = groups.where("v > 0")
    cells = used.groupBy("lang", "source", "n", "lang_n").agg(F.count("*").alias("terms")).join(sized, ["lang", "source"])
    p, q = share(F.col("n"), F.col("size")), share(F.col("lang_n"), F.col("lang_size"))
    cells = materialise(cells.withColumn("value", p - q).where("value > 0").select("lang", "source", "n", "lang_n", "value", "terms"), "term-cells")
    # every value stands for a term at least, so the first values hold the first terms
    values = cells.groupBy("lang", "source", "value").agg(F.sum("terms").alias("terms"))
    values = values.withColumn("place", _first(values, ["lang", "source"], F.col("value").desc())).where(F.col("place") <= ranks)
    before = F.sum("terms").over(W.partitionBy("lang", "source").orderBy("place").rowsBetween(W.unboundedPreceding, -1))
    values = values.withColumn("before", F.coalesce(before, F.lit(0))).where(F.col("before") < ranks).select("lang", "source", "value")
    chosen = cells.join(values, ["lang", "source", "value"]).select("lang", "source", "n", "lang_n", "value")
    terms = used.join(chosen, ["lang", "source", "n", "lang_n"]).select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value")
    terms = terms.withColumn("rank", _first(terms, ["lang", "source"], F.col("value").desc(), F.col("item"))).where(F.col("rank") <= ranks)

    base = share(F.lit(0), F.col("size")).alias("p")
    blocks = sized.groupBy("lang").agg(F.sum("n_used").alias("n"))
    blocks = blocks.select("lang", F.ceil(F.col("n") / BLOCK).cast("int").alias("n_blocks"))
    heads = sized.join(blocks, "lang").select("lang", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)).alias("block"), "source", F.lit(None).cast("string").alias("term"), base)
    entries = used.join(sized.select("lang", "source", "size"), ["lang", "source"]).join(blocks, "lang")
    entries = entries.select("lang", F.pmod(F.xxhash64("term"), "n_blocks").cast("int").alias("block"), "source", "term", share(F.col("n"), F.col("size")).alias("p"))
    sums = heads.unionByName(entries).groupBy("lang", "block").applyInArrow(_sums, "lang string, source string, item string, value long")
    # a language without kept terms has pairs all the same, of value 0
    bare = groups.where("v = 0")
    bare = bare.select("lang", "source").join(bare.select("lang", F.col("source").alias("item")), "lang").withColumn("value", F.lit(0).cast("long"))
    pairs = sums.unionByName(bare.select("lang", "source", "item", "value")).where("source <> item").groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value")
    pairs = pairs.withColumn("rank", _first(pairs, ["lang", "source"], F.col("value").desc(), F.col("item")))
    return pairs.unionByName(terms)


DIVERGENCE_SQL = r"""
WITH docs AS (
    SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
        regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS words
    FROM documents
), occurrences AS (SELECT row, lang, source, unnest(words) AS term FROM docs
), kept AS (SELECT lang, term, count(*) AS lang_n FROM occurrences GROUP BY lang, term HAVING count(DISTINCT row) >= 30
), langs AS (SELECT lang, count(*) AS v, sum(lang_n) AS total FROM kept GROUP BY lang
), used AS (SELECT lang, source, term, count(*) AS n FROM occurrences JOIN kept USING (lang, term) GROUP BY lang, source, term
), totals AS (
    SELECT g.lang, g.source, coalesce(v, 0) AS v, coalesce((SELECT sum(n) FROM used AS u WHERE u.lang = g.lang AND u.source = g.source), 0) AS total
    FROM (SELECT DISTINCT lang, source FROM docs) AS g LEFT JOIN langs USING (lang)
), shares AS (
    SELECT t.lang, t.source, k.term, coalesce(u.n, 0) AS n, 1 + (1000000000::HUGEINT * (coalesce(u.n, 0) + 5)) // (t.total + 5 * t.v) AS p
    FROM totals AS t JOIN kept AS k ON k.lang = t.lang LEFT JOIN used AS u ON u.lang = t.lang AND u.source = t.source AND u.term = k.term
), pairs AS (
    SELECT a.lang, a.source, b.source AS item, coalesce(s.value, 0) AS value
    FROM totals AS a JOIN totals AS b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN (
        SELECT x.lang, x.source, y.source AS item, sum(abs(x.p - y.p)) AS value
        FROM shares AS x JOIN shares AS y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL
    ) AS s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
), terms AS (
    SELECT s.lang, s.source, s.term AS item, s.p - (1 + (1000000000::HUGEINT * (k.lang_n + 5)) // (l.total + 5 * l.v)) AS value
    FROM shares AS s JOIN kept AS k USING (lang, term) JOIN langs AS l USING (lang) WHERE s.n > 0
), ranked AS (
    SELECT lang, source, 'pair' AS part, item, value FROM pairs
    UNION ALL SELECT lang, source, 'term', item, value FROM terms WHERE value > 0
)
SELECT lang, source, part, item, value::BIGINT AS value, place::INTEGER AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS place FROM ranked)
WHERE part = 'pair' OR place <= 50
"""
