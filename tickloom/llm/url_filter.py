"""URL filter: explicit rules, and for the rest a logistic regression on character n-grams.

A rule is a host and a path prefix (``example.org/es/``); it fits the host and its subdomains,
and the longest rule that fits decides. URLs that a rule decides are the labelled table from
which the regression learns, unless the caller brings a table. Training takes at most
``TRAINING_URLS`` distinct labelled URLs, those with the smallest hashes; every URL is judged.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import ascii_lower
from tickloom.llm.words import mix, text_bytes

TRAINING_URLS = 8000
BUCKET_BITS = 18
GRAMS = (3, 4, 5)
STEPS = 120


@dataclass(frozen=True)
class Rule:
    verdict: str  # allow or block
    prefix: str  # host and path, "example.org/es/"

    @property
    def host(self) -> str:
        return self.prefix.partition("/")[0]

    @property
    def path(self) -> str:
        return "/" + self.prefix.partition("/")[2]


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z in lower case) and path of a URL; both empty without a "://"."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    host = ascii_lower(F.regexp_extract(rest, "^[^/?#]*", 0))
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1), F.lit(""))


def matching_rule(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """The longest fitting rule's prefix and verdict, null if none fits. ``block`` wins a tie."""
    prefix, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.prefix), r.verdict, r.prefix)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        prefix = F.when(fits, F.lit(rule.prefix)).otherwise(prefix)
        verdict = F.when(fits, F.lit(rule.verdict)).otherwise(verdict)
    return prefix, verdict


def gram_features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all byte n-grams of all texts, and where each text's begin (the end included)."""
    data, offsets = text_bytes(texts)
    n = len(offsets) - 1
    owner = np.repeat(np.arange(n), np.diff(offsets))
    wide = data.astype(np.uint64) + np.uint64(1)
    buckets, owners = [], []
    for size in GRAMS:
        count = max(0, len(data) - size + 1)
        total = np.full(count, size, np.uint64)
        for k in range(size):
            total = total * np.uint64(1099511628211) + wide[k : k + count]
        inside = owner[:count] == owner[size - 1 : size - 1 + count] if count else np.zeros(0, bool)
        buckets.append((mix(total[inside]) >> np.uint64(64 - BUCKET_BITS)).astype(np.int64))
        owners.append(owner[:count][inside])
    text, bucket = np.concatenate(owners), np.concatenate(buckets)
    order = np.argsort(text, kind="stable")
    return bucket[order], np.searchsorted(text[order], np.arange(n + 1))


def _per_text(values: np.ndarray, begin: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0.0], np.cumsum(values)])
    return total[begin[1:]] - total[begin[:-1]]


@dataclass
class Model:
    weights: np.ndarray
    bias: float

    def probability(self, texts: pa.Array) -> np.ndarray:
        """Probability of ``block``; a URL without n-grams has the bias alone."""
        bucket, begin = gram_features(texts)
        scale = 1 / np.sqrt(np.maximum(np.diff(begin), 1))
        return 1 / (1 + np.exp(-np.clip(self.bias + _per_text(self.weights[bucket], begin) * scale, -30, 30)))


def train(texts: list[str], blocked: list[bool], penalty: float = 1e-5, rate: float = 0.5) -> Model:
    """Penalised logistic regression by adaptive gradient steps. One class alone gives a constant."""
    model = Model(np.zeros(1 << BUCKET_BITS), 0.0)
    if not texts or all(blocked) or not any(blocked):
        model.bias = 3.0 if texts and all(blocked) else -3.0
        return model
    column, wanted = pa.array(texts, pa.string()), np.array(blocked, float)
    bucket, begin = gram_features(column)
    owner = np.repeat(np.arange(len(texts)), np.diff(begin))
    scale = 1 / np.sqrt(np.maximum(np.diff(begin), 1))
    seen, seen_bias = np.full(1 << BUCKET_BITS, 1e-8), 1e-8
    for _ in range(STEPS):
        error = (model.probability(column) - wanted) / len(texts)
        slope = np.bincount(bucket, (error * scale)[owner], minlength=1 << BUCKET_BITS) + penalty * model.weights
        seen += slope * slope
        seen_bias += error.sum() ** 2
        model.weights -= rate * slope / np.sqrt(seen)
        model.bias -= rate * error.sum() / np.sqrt(seen_bias)
    return model


def url_text(host: Column, path: Column) -> Column:
    """What the n-grams are taken of: host and path with their borders marked."""
    return F.when((host == "") & (path == ""), F.lit("")).otherwise(F.concat(F.lit("^"), host, F.lit("\n"), path, F.lit("$")))


def labelled_urls(pages: DataFrame, rules: list[Rule]) -> DataFrame:
    """The labelled table that rules give: (text, verdict) of each distinct URL a rule decides."""
    host, path = url_parts(F.col("url"))
    parts = pages.select(host.alias("host"), path.alias("path"))
    _, verdict = matching_rule(F.col("host"), F.col("path"), rules)
    labelled = parts.select(url_text(F.col("host"), F.col("path")).alias("text"), verdict.alias("verdict"))
    return labelled.where(F.col("verdict").isNotNull()).distinct()


def fit(labelled: DataFrame, most: int = TRAINING_URLS) -> Model:
    """A model from at most ``most`` rows of ``labelled`` (text, verdict), the ones with the smallest hashes."""
    sample = labelled.select("text", "verdict", F.xxhash64("text").alias("h")).orderBy("h", "text", "verdict").limit(most).collect()
    return train([r["text"] for r in sample], [r["verdict"] == "block" for r in sample])


def judge_urls(pages: DataFrame, rules: list[Rule], labelled: DataFrame | None = None) -> DataFrame:
    """Verdict on every row of ``pages`` (page_id, url): page_id, host, path, rule, verdict, p_block.

    ``rules`` is a short list, held in the plan. A null URL, or one without "://", has an empty
    host and path, fits no rule and gets the verdict of the model's bias. Repeated rows are
    judged alike; without labelled URLs the model allows. Other columns are ignored.
    """
    model = fit(labelled_urls(pages, rules) if labelled is None else labelled)
    shared = pages.sparkSession.sparkContext.broadcast((model.weights.astype(np.float32), model.bias))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, bias = shared.value
        ready = Model(weights.astype(np.float64), bias)
        for batch in batches:
            p = ready.probability(batch.column("text"))
            guess = pa.array(np.where(p >= 0.5, "block", "allow").tolist(), pa.string())
            names = ["page_id", "host", "path", "rule"]
            verdict = pa.compute.coalesce(batch.column("verdict"), guess)
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), verdict, pa.array(p)], [*names, "verdict", "p_block"])

    host, path = url_parts(F.col("url"))
    parts = pages.select(F.col("page_id").cast("long"), host.alias("host"), path.alias("path"))
    rule, verdict = matching_rule(F.col("host"), F.col("path"), rules)
    ready = parts.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("verdict"), url_text(F.col("host"), F.col("path")).alias("text"))
    return ready.mapInArrow(judge, "page_id long, host string, path string, rule string, verdict string, p_block double")
