"""Quality rules with risk-controlled cutoffs, in DataFrame functions only.

Each rule compares one figure of a document with a cutoff. Cutoffs are tried from the
mildest on, per stratum, on the labelled documents: a cutoff is certified if the exact
binomial test rejects "more than the rule's share of the good documents would be rejected",
which is to say the exact upper bound of the false rejection rate lies below that share.
Trying stops at the first cutoff that fails (a fixed sequence needs no correction of its
own); the level is divided by the number of strata and rules (Bonferroni). The rules' shares
add up to ``risk``, so with probability ``1 - delta`` no stratum loses more than ``risk`` of
its good documents. Without enough labels nothing is certified, and the rules reject nothing.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tickloom.llm.common import WHITE_SPACE, bind, materialise

SYMBOLS = "#*$%&|<>"
RISK = 0.02
DELTA = 0.05
#: Labelled ids (8 bytes each) that are broadcast to where the texts are read.
BROADCAST_LABELS = 4_000_000
#: Rule: (figure, cutoffs from mild to strict). A document is rejected above the cutoff.
RULES = {
    "symbols": ("symbols_per_word", [2.0, 1.0, 0.7, 0.5, 0.3, 0.2, 0.1, 0.05]),
    "duplicate_lines": ("dup_line_share", [0.9, 0.7, 0.5, 0.4, 0.3, 0.2]),
    "repeated_words": ("repeat_share", [0.45, 0.4, 0.35, 0.3, 0.25, 0.2, 0.15]),
    "long_words": ("mean_word_chars", [40.0, 30.0, 20.0, 16.0, 13.0, 11.0, 10.0]),
}
FIGURES = {
    "symbols_per_word": "n_symbols / n_words",
    "dup_line_share": "n_dup_lines / n_word_lines",
    "repeat_share": "n_repeat_words / n_words",
    "mean_word_chars": "word_chars / n_words",
}
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _only(text: Column, kept: str) -> Column:
    """Code points of the character class ``kept`` in a text."""
    return F.char_length(F.regexp_replace(text, f"[^{kept}]+", "")).cast("long")


def _repeated(windows: Column) -> Column:
    """Words in windows whose hash occurs twice or more, given the windows' hashes in order."""

    def places(ordered: Column) -> Column:
        def shared(entry: Column, i: Column) -> Column:
            neighbours = [F.get(ordered, i + step)["h"] == entry["h"] for step in (-1, 1)]
            return F.coalesce(neighbours[0], F.lit(False)) | F.coalesce(neighbours[1], F.lit(False))

        covered = F.transform(F.filter(ordered, shared), lambda e: F.array(e["i"], e["i"] + 1, e["i"] + 2))
        return F.size(F.array_distinct(F.flatten(covered)))

    pairs = F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    return F.when(F.size(F.array_distinct(windows)) == F.size(windows), 0).otherwise(bind(F.sort_array(pairs), places))


def _word_counts(text: Column) -> Column:
    def of_words(words: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(words) - 3)
        hashes = F.transform(starts, lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)))
        repeated = F.when(F.size(words) < 4, 0).otherwise(bind(hashes, _repeated))
        return F.struct(F.size(words).cast("long").alias("n_words"), repeated.cast("long").alias("n_repeat_words"))

    trimmed = F.btrim(text, F.lit(WHITE_SPACE))
    empty = F.array().cast("array<string>")
    words = F.when(trimmed == "", empty).otherwise(F.split(trimmed, "[\\x20\\x09-\\x0D]+"))
    return bind(words, of_words)


def _line_counts(text: Column) -> Column:
    with_word = F.filter(F.split(text, "\n"), lambda line: F.btrim(line, F.lit(WHITE_SPACE)) != "")
    return bind(
        with_word,
        lambda lines: F.struct(
            F.size(lines).cast("long").alias("n_word_lines"),
            (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        ),
    )


def text_counts(docs: DataFrame) -> DataFrame:
    """``docs`` with the counts over its whole texts, and base_failed. A null text has no words."""
    text = F.coalesce(F.col("text"), F.lit(""))
    measured = docs.select(
        "*",
        _word_counts(text).alias("_words"),
        _line_counts(text).alias("_lines"),
        (F.char_length(text) - _only(text, "\\x20\\x09-\\x0D")).alias("word_chars"),
        _only(text, SYMBOLS).alias("n_symbols"),
    )
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return measured.select("*", "_words.*", "_lines.*").drop("_words", "_lines").withColumn("base_failed", failed)


def binomial_p_value(k: Column, n: Column, share: float) -> Column:
    """P(at most k of n) if each has probability ``share``; 1 where k isn't below the mean.

    Summed in logarithms by the ratio of neighbouring terms, so large n don't underflow.
    """
    first = F.lit(math.log1p(-share)) * n
    odds = math.log(share) - math.log1p(-share)

    def add(state: Column, i: Column) -> Column:
        term = state["term"] + F.ln((n - i + 1) / i) + F.lit(odds)
        more = term + F.ln(F.lit(1.0) + F.exp(state["total"] - term))  # terms grow up to the mean
        return F.struct(term.alias("term"), more.alias("total"))

    steps = F.when(k >= 1, F.sequence(F.lit(1).cast("long"), k)).otherwise(F.array().cast("array<bigint>"))
    tail = F.aggregate(steps, F.struct(first.alias("term"), first.alias("total")), add, lambda state: F.exp(state["total"]))
    return F.when(k >= n * share, 1.0).otherwise(tail)


def certify(counts: DataFrame, labels: DataFrame, stratum: str, risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """Cutoffs chosen per stratum and rule: (stratum, rule, cutoff), certified ones only.

    ``counts`` has doc_id, the stratum, the counts; ``labels`` has doc_id and quality (1 good,
    0 bad, null unknown). A document labelled twice is good if one label says so. A trial is a
    document: rows that repeat it, with the same id and (by ``text_key``, its hash, or else by the
    counts) the same text, count once. Among certified cutoffs the one that rejects most bad
    documents is chosen, the mildest of equals.
    """
    share = risk / len(RULES)
    judged = labels.where("quality IS NOT NULL").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    same = ["doc_id", stratum, "text_key"] if "text_key" in counts.columns else ["doc_id", stratum, *COUNTS]
    holdout = counts.where(~F.col("base_failed")).join(judged, "doc_id").dropDuplicates(same)
    grid = F.explode(
        F.array(
            *[
                F.struct(F.lit(rule).alias("rule"), F.lit(step).alias("step"), F.lit(cutoff).alias("cutoff"), (F.expr(FIGURES[figure]) > cutoff).alias("out"))
                for rule, (figure, cutoffs) in RULES.items()
                for step, cutoff in enumerate(cutoffs)
            ]
        )
    )
    good = F.col("quality") >= 1
    tried = (
        holdout.select(F.col(stratum).alias("stratum"), "quality", grid.alias("g"))
        .select("stratum", "quality", "g.*")
        .groupBy("stratum", "rule", "step", "cutoff")
        .agg(
            F.count(F.when(good, 1)).alias("n_good"),
            F.count(F.when(good & F.col("out"), 1)).alias("good_out"),
            F.count(F.when(~good & F.col("out"), 1)).alias("bad_out"),
        )
    )
    tried = materialise(tried, "quality-trials")  # some thirty rows a stratum
    n_strata = tried.select("stratum").distinct().count()
    tests = tried.withColumn("p_value", binomial_p_value(F.col("good_out"), F.col("n_good"), share))
    in_order = W.partitionBy("stratum", "rule").orderBy("step").rowsBetween(W.unboundedPreceding, 0)
    passed = (
        tests.withColumn("ok", F.col("p_value") <= F.lit(delta / len(RULES) / max(n_strata, 1)))
        .withColumn("certified", F.min("ok").over(in_order))
        .where("certified AND bad_out > 0")
    )
    best = W.partitionBy("stratum", "rule").orderBy(F.col("bad_out").desc(), "step")
    return passed.withColumn("place", F.row_number().over(best)).where("place = 1").select("stratum", "rule", "cutoff")


def judge(docs: DataFrame, labels: DataFrame, stratum: str = "lang", risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """Counts, base_failed and kept for every row of ``docs`` (doc_id, text, stratum column).

    A row is kept unless the base rules fail it or one of its stratum's certified cutoffs
    rejects it. Null ids have no label; a null stratum is a stratum; empty and null texts have
    no words and fail the base; repeated rows are judged alike; no labels certify nothing.
    Other columns are ignored. The text is read once: counts are written and reread.
    """
    narrow = docs.select("doc_id", F.col(stratum).cast("string").alias("stratum"), "text", F.xxhash64("text").alias("text_key"))
    counts = materialise(text_counts(narrow).drop("text"), "quality-counts")
    chosen = certify(counts, labels.select("doc_id", "quality"), "stratum", risk, delta)
    # a row per stratum: as many rows as there are strata
    per_stratum = chosen.groupBy("stratum").agg(
        *[F.min(F.when(F.col("rule") == rule, F.col("cutoff"))).alias(f"cut_{rule}") for rule in RULES]
    )
    cuts = per_stratum.withColumnRenamed("stratum", "cut_stratum")
    out = F.lit(False)
    for rule, (figure, _) in RULES.items():
        out = out | F.coalesce(F.expr(FIGURES[figure]) > F.col(f"cut_{rule}"), F.lit(False))
    joined = counts.join(cuts, counts["stratum"].eqNullSafe(cuts["cut_stratum"]), "left")
    return joined.withColumn("kept", ~F.col("base_failed") & ~out).select("doc_id", "stratum", *COUNTS, "base_failed", "kept")


def filter_documents(docs: DataFrame, labels: DataFrame, stratum: str = "lang") -> DataFrame:
    """The rows and columns of ``docs`` that ``judge`` keeps.

    The cutoffs come from one pass that counts labelled documents only; a second pass over all
    rows applies them in place. Texts stay where they are, unless labels are too many to be
    broadcast: then texts are shuffled once, to their labels. What holds for ``judge`` holds here.
    """
    names = docs.columns
    labelled = materialise(labels.where("quality IS NOT NULL").select("doc_id").distinct(), "labelled")
    if labelled.count() <= BROADCAST_LABELS:
        labelled = F.broadcast(labelled)
    narrow = docs.select("doc_id", F.col(stratum).cast("string").alias("stratum"), "text", F.xxhash64("text").alias("text_key"))
    counts = materialise(text_counts(narrow.join(labelled, "doc_id", "left_semi")).drop("text"), "quality-counts")
    chosen = materialise(certify(counts, labels.select("doc_id", "quality"), "stratum"), "quality-cutoffs")
    cuts = chosen.groupBy("stratum").agg(
        *[F.min(F.when(F.col("rule") == rule, F.col("cutoff"))).alias(f"cut_{rule}") for rule in RULES]
    )
    packed = docs.select(F.struct("*").alias("row"))
    judged = text_counts(packed.select("row", F.col(f"row.{stratum}").cast("string").alias("stratum"), F.col("row.text").alias("text")))
    out = F.col("base_failed")
    for rule, (figure, _) in RULES.items():
        out = out | F.coalesce(F.expr(FIGURES[figure]) > F.col(f"cut_{rule}"), F.lit(False))
    cuts = cuts.withColumnRenamed("stratum", "cut_stratum")
    kept = judged.join(cuts, judged["stratum"].eqNullSafe(cuts["cut_stratum"]), "left").where(~out)
    return kept.select(*[F.col("row")[name].alias(name) for name in names])
