"""The similarity join of locations, bounded before any two areas are matched.

A ratio of matching blocks is 2M / (|a| + |b|), and M is at most the number of letters that both areas have, counted with repeats. So an
area is a set of (letter, how many-th) tokens, and a ratio of t needs t (|a| + |b|) / 2 common ones. Tokens are ordered from rare to
frequent; two areas with that many in common share a token among the first n - ceil(n t / (2 - t)) + 1 of each, and only pairs that do are
formed, by an equi-join within their block. The bound from all letters, in the arithmetic of the ratio itself, then takes out the rest on
the JVM; matching sees what is left. Between municipalities a ratio counts ELSEWHERE of itself, so more letters must agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dirbook.functions.similarity import ELSEWHERE


def letters(text: Column) -> Column:
    """The tokens of a text: each code point with its number among equal ones."""
    points = F.regexp_extract_all(text, F.lit("(?s)."), F.lit(0))
    return F.transform(points, lambda x, i: F.concat(x, F.size(F.filter(F.slice(points, F.lit(1), i + 1), lambda y: y == x)).cast("string")))


def bound(left: Column, right: Column, factor: Column) -> Column:
    """What a ratio times factor can't exceed, from the tokens of both texts; computed as the ratio is, so that it never falls below."""
    common = F.size(F.array_intersect(left, right))
    return F.when(common == 0, F.lit(0.0)).otherwise(2.0 * common / (F.size(left) + F.size(right)) * factor)


def prefixes(side: DataFrame, frequency: DataFrame, ratio: float) -> DataFrame:
    """side(id, tokens, ...) with a row for each token of its prefix; frequency(token, n): how frequent tokens are."""
    one = side.withColumn("token", F.explode("tokens")).join(frequency, "token", "left")
    place = F.row_number().over(Window.partitionBy("id").orderBy(F.coalesce("n", F.lit(0)), "token"))
    needed = F.ceil(F.size("tokens") * (ratio / (2 - ratio)) - 1e-9)
    return one.withColumn("place", place).where(F.col("place") <= F.size("tokens") - needed + 1).drop("place", "n")


def bounded_pairs(odd: DataFrame, counts: DataFrame, common_min: int, min_similarity: float) -> DataFrame:
    """(id, candidate, block, seen): the pairs of an odd location with a frequent one of its municipality (block 0), of its prefecture and
    first letter (1) or, where there are none of these, of its prefecture (2), whose letters allow the similarity, which is over 0."""
    sides = lambda df: df.select("id", "prefecture", F.col("municipality").alias("m"), F.substring("comparable", 1, 1).alias("initial"), letters(F.col("comparable")).alias("tokens"), F.col("first_seen").alias("seen"))
    left = sides(odd)
    frequent = counts.where((F.col("count") >= common_min) & (F.col("comparable") != ""))
    right = sides(frequent)
    frequency = right.select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count("*").alias("n"))
    alone = left.join(right.select("prefecture", "m").distinct(), ["prefecture", "m"], "left_anti").join(right.select("prefecture", "initial").distinct(), ["prefecture", "initial"], "left_anti")

    def pairs(some: DataFrame, by: list[str], factor: float, block: int) -> DataFrame:
        ratio = min_similarity / factor
        if ratio > 1:
            return some.limit(0).select("id", F.lit("").alias("candidate"), F.lit(block).alias("block"), F.lit(0).cast("long").alias("seen"))
        a = prefixes(some, frequency, ratio).select("id", "token", *[c for c in ("prefecture", "m", "initial") if c in by], F.col("m").alias("m_a"), F.col("tokens").alias("tokens_a"))
        b = prefixes(right, frequency, ratio).select(F.col("id").alias("candidate"), "token", *[c for c in ("prefecture", "m", "initial") if c in by], F.col("m").alias("m_b"), F.col("tokens").alias("tokens_b"), "seen")
        met = a.join(b, [*by, "token"]).where("id <> candidate")
        if block:
            met = met.where(~F.col("m_a").eqNullSafe(F.col("m_b")))
        close = met.where(bound(F.col("tokens_a"), F.col("tokens_b"), F.lit(factor)) >= min_similarity)
        return close.groupBy("id", "candidate").agg(F.lit(block).alias("block"), F.min("seen").alias("seen"))

    found = pairs(left, ["prefecture", "m"], 1.0, 0).unionByName(pairs(left.where("initial <> ''"), ["prefecture", "initial"], ELSEWHERE, 1))
    return found.unionByName(pairs(alone, ["prefecture"], ELSEWHERE, 2))


def pair_counts(odd: DataFrame, counts: DataFrame, common_min: int, min_similarity: float) -> DataFrame:
    """(stage, pairs): how many pairs blocks alone would form, by their sizes, and how many are left to be matched."""
    keys = lambda df: df.select("prefecture", F.col("municipality").alias("m"), F.substring("comparable", 1, 1).alias("initial"))
    left, right = keys(odd), keys(counts.where((F.col("count") >= common_min) & (F.col("comparable") != "")))

    def product(by: list[str], sign: int) -> DataFrame:
        n = lambda df, name: df.where("initial <> ''" if "initial" in by else "true").groupBy(*by).agg(F.count("*").alias(name))
        return n(left, "a").join(n(right, "b"), by).select((F.col("a") * F.col("b") * sign).alias("pairs"))

    blocked = product(["prefecture", "m"], 1).unionByName(product(["prefecture", "initial"], 1)).unionByName(product(["prefecture", "m", "initial"], -1))
    matched = bounded_pairs(odd, counts, common_min, min_similarity)
    return blocked.agg(F.lit("blocked").alias("stage"), F.coalesce(F.sum("pairs"), F.lit(0)).alias("pairs")).unionByName(matched.where("block < 2").agg(F.lit("matched").alias("stage"), F.count("*").alias("pairs")))
