"""Sharding by a Feistel permutation of global row numbers, in DataFrame functions only.

Rows get numbers 0 to N-1; a keyed Feistel network permutes the numbers; number p then
lies in shard ``p % shards`` at slot ``p // shards``. Both can be computed for any row
number without touching another row, shards differ by one row at most, and slots have no
gaps. The network works on a rectangle ``left x right`` of at least N cells; a number that
leaves 0..N-1 is permuted again until it is back (cycle walking). At most
``left * right - N`` cells, under the square root of N, lie outside, so a walk ends after
that many steps at the latest.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

ROUNDS = 4
_PRIME = 4294967291  # the largest below 2**32
#: Equal rows that are written out at once.
CHUNK = 1 << 20


def scramble(x: Column, key: int) -> Column:
    """A well mixed number below 2**32 from one of 0 to 2**32 - 1, within 64-bit sums."""
    x = (x + F.lit(key)) % F.lit(_PRIME) * F.lit(1540483477) % F.lit(_PRIME)
    x = x.bitwiseXOR(F.shiftright(x, 15)) * F.lit(1103515245) % F.lit(_PRIME)
    return x.bitwiseXOR(F.shiftright(x, 13))


def round_keys(seed: int) -> list[int]:
    return [(seed * 2654435761 + 40503 * (r + 1) * (r + 7)) % _PRIME for r in range(ROUNDS)]


def rectangle(n: int) -> tuple[int, int]:
    """Sides of the smallest near-square rectangle with at least n cells."""
    left = max(1, math.isqrt(max(n - 1, 0)) + 1)
    return left, max(1, -(-n // left))


def permute(number: Column, n: int, seed: int) -> Column:
    """The place of row ``number`` (0..n-1) in the shuffle of n rows; a bijection of 0..n-1."""
    left, right = rectangle(n)
    keys = round_keys(seed)

    def network(x: Column) -> Column:
        halves = F.struct(F.floor(x / F.lit(right)).cast("long").alias("a"), (x % F.lit(right)).alias("b"))

        def step(state: Column, r: int) -> Column:
            a, b = state["a"], state["b"]
            if r % 2 == 0:
                return F.struct(((a + scramble(b, keys[r])) % F.lit(left)).alias("a"), b.alias("b"))
            return F.struct(a.alias("a"), ((b + scramble(a, keys[r])) % F.lit(right)).alias("b"))

        def turn(r: int):
            return lambda state: step(state, r)

        # one lambda per round: each state is computed once, though used twice
        done = reduce(lambda states, r: F.transform(states, turn(r)), range(ROUNDS), F.array(halves))
        return F.transform(done, lambda s: s["a"] * F.lit(right) + s["b"])[0]

    outside = left * right - n
    once = network(number)
    if outside == 0:
        return once

    def walk(x: Column) -> Column:
        steps = F.sequence(F.lit(1), F.lit(outside))
        back = F.aggregate(steps, x, lambda y, _: F.when(y < n, y).otherwise(network(y)))
        return F.when(x < n, x).otherwise(back)

    return F.transform(F.array(once), walk)[0]


def numbered(rows: DataFrame, identity: list[str], grains: int = 4096) -> DataFrame:
    """The columns ``identity`` of all rows and ``row_number``, 0 to N-1: the place in the order of (grain, identity).

    ``identity`` are whole-number columns; the same rows get the same numbers however they
    are partitioned. The grain is a hash of the identity, so that rows are sorted in
    ``grains`` equal parts; only the parts' counts are summed up in one place. Rows equal in
    all of ``identity`` are counted before the shuffle, sorted as one, and written out again,
    ``CHUNK`` at a time; they share their numbers, nulls come first.
    """
    mixed = F.lit(17).cast("long")
    for name in identity:
        value = F.pmod(F.coalesce(F.col(name).cast("long"), F.lit(-1).cast("long")), F.lit(_PRIME))
        mixed = (mixed.bitwiseXOR(value) % F.lit(_PRIME) * F.lit(1540483477) + F.lit(97)) % F.lit(_PRIME)
    equal = rows.groupBy(*identity).agg(F.count("*").alias("copies"))
    cut = equal.withColumn("grain", F.shiftright(mixed, 7) % F.lit(grains))
    before = W.orderBy("grain").rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        cut.groupBy("grain")
        .agg(F.sum("copies").alias("grain_rows"))
        .select("grain", F.coalesce(F.sum("grain_rows").over(before), F.lit(0)).alias("grain_offset"))
    )
    order = W.partitionBy("grain").orderBy(*[F.col(c).asc_nulls_first() for c in identity])
    earlier = F.coalesce(F.sum("copies").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    placed = cut.withColumn("place", earlier).join(offsets, "grain")
    chunks = placed.select(
        *identity,
        (F.col("grain_offset") + F.col("place")).alias("first_number"),
        "copies",
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1, F.lit(CHUNK).cast("long"))).alias("chunk"),
    )
    last = F.least(F.col("chunk") + CHUNK, F.col("copies")) - 1
    each = chunks.select(*identity, "first_number", F.explode(F.sequence("chunk", last)).alias("copy"))
    return each.select(*identity, (F.col("first_number") + F.col("copy")).alias("row_number"))


def shard(docs: DataFrame, shards: int = 40, seed: int = 2024) -> DataFrame:
    """Shard and slot of every row of ``docs`` (doc_id, text), law ``rows``.

    Returns doc_id, size (UTF-8 bytes of the text plus 16), text_crc32, row_number, shard,
    slot. A null text has no bytes and the checksum 0; a null id counts like any other;
    repeated rows each get their own slot; no rows give no rows. Other columns are ignored.
    The text itself is read once and never shuffled.
    """
    if shards < 1:
        raise ValueError("there must be a shard at least")
    content = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(
        F.col("doc_id"),
        (F.octet_length(content).cast("long") + 16).alias("size"),
        F.crc32(content.cast("binary")).alias("text_crc32"),
    )
    n = docs.count()
    place = permute(F.col("row_number"), n, seed)
    return (
        numbered(rows, ["doc_id", "text_crc32", "size"])
        .withColumn("permuted", place)
        .select(
            "doc_id",
            "size",
            "text_crc32",
            "row_number",
            (F.col("permuted") % shards).cast("int").alias("shard"),
            F.floor(F.col("permuted") / F.lit(shards)).cast("long").alias("slot"),
        )
    )
