"""F5 for member sets too large to broadcast: a Bloom filter before the exchange.

The members' bits are set by aggregation: each member gives a few places, places
are grouped into words of 64 bits and OR-ed, and the words become one array.
Rows are tested against it in the scan's stage, so only members and a known
share of others reach the exchange of the exact semi join that follows.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, functions as F

MOST_BITS = 1 << 26      # 8 MB go to every task at most; with more members the share of others grows, the result is the same
SPREAD = 1 << 13         # words of one group when they are put in order


def bloom_size(members: int, share: float, most_bits: int = MOST_BITS) -> tuple[int, int]:
    """(bits, places of a member) for a share of false positives, in whole words."""
    wanted = -members * math.log(share) / math.log(2) ** 2
    bits = min(most_bits, 64 * max(1, math.ceil(wanted / 64)))
    return bits, max(1, min(8, round(bits / max(1, members) * math.log(2))))


def _places(column: str, bits: int, k: int) -> list:
    return [F.pmod(F.xxhash64(F.lit(i), F.col(f"`{column}`")), F.lit(bits)) for i in range(k)]


def bloom_words(members: DataFrame, column: str, bits: int, k: int) -> DataFrame:
    """One row, ``words``: the filter as an array of ``bits / 64`` longs."""
    place = F.explode(F.array(*_places(column, bits, k)))
    own = (members.where(F.col(f"`{column}`").isNotNull()).select(place.alias("place"))
           .groupBy(F.shiftright("place", 6).alias("word"))
           .agg(F.expr("bit_or(shiftleft(1L, CAST(place & 63 AS INT)))").alias("bits")))
    # words without a member are 0; runs of words are put in order by many tasks
    every = members.sparkSession.range(bits // 64).select(F.col("id").alias("word"), F.lit(0).cast("long").alias("bits"))
    words = own.unionByName(every).groupBy("word").agg(F.bit_or("bits").alias("bits"))
    runs = words.groupBy(F.floor(F.col("word") / SPREAD).alias("run")).agg(F.sort_array(F.collect_list(F.struct("word", "bits"))).alias("own"))
    whole = runs.agg(F.sort_array(F.collect_list(F.struct("run", F.col("own.bits").alias("bits")))).alias("runs"))
    return whole.select(F.flatten(F.col("runs.bits")).alias("words"))


def keep_likely_members(df: DataFrame, column: str, members: DataFrame, member_column: str | None = None,
                        share: float = 0.03, most_bits: int = MOST_BITS) -> DataFrame:
    """Rows whose value is a member, and about ``share`` of the others; map only."""
    member_column = member_column or column
    bits, k = bloom_size(members.count(), share, most_bits)
    words = bloom_words(members, member_column, bits, k)
    tests = [f"((get(words, CAST(shiftright(__p{i}, 6) AS INT)) >> CAST(__p{i} & 63 AS INT)) & 1) = 1" for i in range(k)]
    for i in range(k):
        tests[i] = tests[i].replace("words", "(SELECT words FROM {filter})")
    placed = df.select("*", *[p.alias(f"__p{i}") for i, p in enumerate(_places(column, bits, k))])
    kept = df.sparkSession.sql(f"SELECT * FROM {{rows}} WHERE {' AND '.join(tests)}", rows=placed, filter=words)
    return kept.drop(*[f"__p{i}" for i in range(k)])


def keep_members_prefiltered(df: DataFrame, column: str, members: DataFrame, member_column: str | None = None,
                             share: float = 0.03, most_bits: int = MOST_BITS) -> DataFrame:
    """F5 as ``filters.keep_members``: the filter first, then the exact semi join."""
    likely = keep_likely_members(df, column, members, member_column, share, most_bits)
    right = members.select(F.col(f"`{member_column or column}`").alias("__member"))
    return likely.join(right, F.col(f"`{column}`") == F.col("__member"), "left_semi")
