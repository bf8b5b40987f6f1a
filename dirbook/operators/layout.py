"""Layout scores from column metrics, as column work."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FATAL_FLAGS = ("uneven_column_widths",)


def width_stats(columns: DataFrame, by: list[str], width: str) -> DataFrame:
    """(by, n, mean, std, cv, least, greatest): population deviation; ratios are to the mean, 0 where that isn't positive."""
    found = columns.groupBy(*by).agg(F.count("*").alias("n"), F.avg(width).alias("mean_width"), F.stddev_pop(width).alias("std_width"), F.min(width).alias("low"), F.max(width).alias("high"))
    ratio = lambda c: F.when(F.col("mean_width") > 0, F.col(c) / F.col("mean_width")).otherwise(0.0)
    return found.select(*by, "n", "mean_width", ratio("std_width").alias("cv"), ratio("low").alias("min_ratio"), ratio("high").alias("max_ratio"))


def layout_score(separators: Column, content: Column, cv: Column, low: Column, high: Column, loss: Column, observed: Column, n: Column) -> Column:
    """How plausible a layout of n columns is; more is better."""
    over = lambda c: F.greatest(c, F.lit(0.0))
    surplus = F.greatest(observed + 1 - n, F.lit(0)).cast("double")
    habit = F.when(n == 2, F.lit(0.05)).when(n == 4, F.lit(0.02)).otherwise(F.lit(0.0))
    return 3.0 * separators + content - 2.5 * cv - 3.0 * over(0.55 - low) - 2.0 * over(high - 1.6) - 4.0 * over(loss - 0.03) - 0.30 * surplus - habit


def best_layout(scores: DataFrame, page: str, n: str, score: str) -> DataFrame:
    """The best layout of each page; of equal ones, that with fewest columns."""
    return scores.groupBy(page).agg(F.max_by(F.struct(F.col(n), F.col(score)), F.struct(F.col(score), -F.col(n))).alias("x")).select(page, "x.*")


def count_mode(pages: DataFrame, value: str, order: str) -> DataFrame:
    """(value, pages, is_mode): a histogram; of equally frequent values the one seen first is the mode."""
    counts = pages.groupBy(value).agg(F.count("*").alias("pages"), F.min(order).alias("first"))
    best = counts.agg(F.max_by(value, F.struct(F.col("pages"), -F.col("first"))).alias("mode"))
    return counts.crossJoin(F.broadcast(best)).select(value, "pages", (F.col(value) == F.col("mode")).alias("is_mode"))  # one row


def flag_counts(rows: DataFrame, flags: str) -> DataFrame:
    return rows.select(F.explode(flags).alias("flag")).groupBy("flag").agg(F.count("*").alias("n"))


def fatal(flags: Column) -> Column:
    return F.arrays_overlap(flags, F.array(*map(F.lit, FATAL_FLAGS)))


def excluded_pages(pages: DataFrame, page: str, exact: list[str], ranges: list[tuple[str, str]]) -> DataFrame:
    """pages without those listed or in an inclusive range of strings; a reversed range counts as turned round."""
    inside = F.col(page).isin(*exact) if exact else F.lit(False)
    for low, high in (sorted(r) for r in ranges):
        inside = inside | F.col(page).between(low, high)
    return pages.where(~inside)


def quality_flags(cv: Column, inks: Column, median: Column, edge: Column, page_ink: Column) -> Column:
    found = F.array(
        F.when(cv > 0.18, F.lit("uneven_column_widths")),
        F.when((median > 0) & F.exists(inks, lambda x: x < 0.35 * median), F.lit("possible_blank_or_underfilled_column")),
        F.when((page_ink > 0) & (edge > F.greatest(F.lit(0.30), 1.85 * page_ink)), F.lit("possible_text_cut_at_column_edge")),
    )
    return F.filter(found, lambda x: x.isNotNull())
