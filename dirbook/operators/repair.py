"""The repair stage: rare or odd locations, their likely originals, decisions, corrections.

Locations are few against rows: one aggregation (combined before its shuffle) brings them down, and all joins are
between locations. Similar ones are sought in blocks: the same municipality, or the same first character.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dirbook import dictionary as D
from dirbook.functions.similarity import rounded, similarity
from dirbook.functions.text import comparable, location_id, normalized
from dirbook.operators.similar import bounded_pairs
from dirbook.operators.windows import in_order

KEY = ["prefecture", "municipality", "area"]


def normal_keys(rows: DataFrame) -> DataFrame:
    """rows with their locations in compatibility composition and stripped, the form in which they are counted and matched."""
    return rows.withColumns({c: normalized(F.col(c)) for c in KEY})


def location_counts(rows: DataFrame) -> DataFrame:
    """(id, prefecture, municipality, area, count, first_seen, comparable) of rows(row_idx, KEY...) with an area; spellings that
    normalise alike are one location."""
    counted = normal_keys(rows.select("row_idx", *KEY)).where(F.col("area") != "").groupBy(*KEY).agg(F.count("*").alias("count"), F.min("row_idx").alias("first_seen"))
    return counted.select(location_id(*map(F.col, KEY)).alias("id"), *KEY, "count", "first_seen", comparable(F.col("area")).alias("comparable"))


def text_reasons(version: str, strict_parity: bool = True) -> Column:
    """What is odd about an area, sorted; built-in work by generated patterns."""
    area, municipality = F.col("area"), F.col("municipality")
    local = F.regexp_replace(F.regexp_replace(municipality, "^.*郡", ""), "[市町村区]$", "")
    names = D.hints(version, strict_parity)
    starts = lambda some: area.rlike(f"^(?:{'|'.join(some)})." if some else "(?!)")
    hinted = starts([n for n in names if len(n) > 1]) | (municipality.startswith("大阪市") & starts([n for n in names if len(n) == 1]))
    found = F.array(
        F.when(area.rlike("大阪[府市]"), F.lit("area_contains_prefecture_or_city")),
        F.when(area.rlike("[,、，]"), F.lit("area_contains_separator")),
        F.when(area.rlike(r"[^\s]{1,12}区"), F.lit("area_contains_ward_name")),
        F.when(hinted, F.lit("area_starts_with_municipality_hint")),
        F.when((municipality != "") & (area != local) & area.startswith(local), F.lit("area_starts_with_own_municipality_name")),
    )
    return F.filter(found, lambda x: x.isNotNull())


def suspicious(counts: DataFrame, rare_max: int = 2, version: str = D.EARLY) -> DataFrame:
    """Locations with a reason: odd text, or few rows."""
    rare = F.when(F.col("count") <= rare_max, F.array(F.lit("rare_location"))).otherwise(F.array().cast("array<string>"))
    return counts.withColumn("reasons", F.array_sort(F.concat(text_reasons(version), rare))).where(F.size("reasons") > 0)


def common(counts: DataFrame, common_min: int) -> DataFrame:
    return counts.where((F.col("count") >= common_min) & (F.col("comparable") != ""))


def block_pairs(left: DataFrame, frequent: DataFrame) -> DataFrame:
    """(id, candidate): locations and frequent ones of their municipality (block 0) or first character (block 1), each
    pair once, from its first block. Two equi-joins; no other pair is ever formed."""
    right = frequent.select(F.col("id").alias("candidate"), "prefecture", F.col("municipality").alias("m"), F.substring("comparable", 1, 1).alias("initial"), F.col("first_seen").alias("seen"))
    left = left.select("id", "prefecture", F.col("municipality").alias("m"), F.substring("comparable", 1, 1).alias("initial"))
    same_place = left.join(right.drop("initial"), ["prefecture", "m"]).select("id", "candidate", "seen", F.lit(0).alias("block"))
    same_initial = left.where("initial <> ''").join(right.drop("m"), ["prefecture", "initial"]).select("id", "candidate", "seen", F.lit(1).alias("block"))
    return same_place.unionByName(same_initial).groupBy("id", "candidate").agg(F.min("block").alias("block"), F.min("seen").alias("seen"))


def _with_sides(pairs: DataFrame, counts: DataFrame) -> DataFrame:
    left = counts.select("id", F.col("prefecture").alias("lp"), F.col("municipality").alias("lm"), F.col("comparable").alias("la"))
    right = counts.select(F.col("id").alias("candidate"), F.col("prefecture").alias("rp"), F.col("municipality").alias("rm"), F.col("area").alias("ra"), F.col("comparable").alias("r"), F.col("count").alias("candidate_count"))
    return pairs.join(left, "id").join(right, "candidate")


def similar_candidates(odd: DataFrame, counts: DataFrame, common_min: int = 8, min_similarity: float = 0.72, top: int = 8) -> DataFrame:
    """(id, candidate, rank, similarity, candidate_count): the most similar frequent locations of each odd one.

    By similarity before rounding, then count, then the order in which blocks list them. Where both blocks are empty, all
    frequent locations of the prefecture are tried. Only pairs whose letters allow the similarity are formed.
    """
    if min_similarity > 0:
        pairs = bounded_pairs(odd, counts, common_min, min_similarity)
    else:  # even areas without a common letter are similar enough
        blocked = block_pairs(odd, common(counts, common_min))
        none = odd.join(blocked.select("id").distinct(), "id", "left_anti").select("id", "prefecture")
        anywhere = counts.where((F.col("count") >= common_min) & (F.col("area") != "")).select(F.col("id").alias("candidate"), "prefecture", F.col("first_seen").alias("seen"))
        pairs = blocked.unionByName(none.join(anywhere, "prefecture").select("id", "candidate", F.lit(2).alias("block"), "seen"))
    sides = _with_sides(pairs.where("id <> candidate"), counts)
    scored = sides.withColumn("score", similarity(F.col("la"), F.col("r"), F.col("lm") == F.col("rm"))).where(F.col("score") >= min_similarity)
    rank = F.row_number().over(Window.partitionBy("id").orderBy(F.desc("score"), F.desc("candidate_count"), "block", "seen"))
    return scored.withColumn("rank", rank).where(F.col("rank") <= top).select("id", "candidate", "rank", rounded(F.col("score"), 4).alias("similarity"), "candidate_count")


def fallback_candidates(odd: DataFrame, counts: DataFrame, common_min: int = 8, top: int = 8) -> DataFrame:
    """(id, candidate, rank, candidate_count): frequent locations of the same municipality and first character, by count."""
    right = counts.where((F.col("count") >= common_min) & (F.col("area") != "")).select(F.col("id").alias("candidate"), "prefecture", "municipality", F.substring("comparable", 1, 1).alias("ri"), F.col("count").alias("candidate_count"), F.col("first_seen").alias("seen"))
    left = odd.select("id", "prefecture", "municipality", F.substring("comparable", 1, 1).alias("li"))
    pairs = left.join(right, ["prefecture", "municipality"]).where("id <> candidate AND (li = '' OR ri = '' OR li = ri)")
    rank = F.row_number().over(Window.partitionBy("id").orderBy(F.desc("candidate_count"), "seen"))
    return pairs.withColumn("rank", rank).where(F.col("rank") <= top).select("id", "candidate", "rank", "candidate_count")


def candidates(odd: DataFrame, counts: DataFrame, common_min: int = 8, min_similarity: float = 0.72, top: int = 8) -> DataFrame:
    """Similar candidates, or the fallback for locations that have none and are more than rare."""
    near = similar_candidates(odd, counts, common_min, min_similarity, top)
    rest = odd.where(F.exists("reasons", lambda r: r != "rare_location")).join(near.select("id").distinct(), "id", "left_anti")
    more = _with_sides(fallback_candidates(rest, counts, common_min, top).drop("candidate_count"), counts)
    scored = more.select("id", "candidate", "rank", rounded(similarity(F.col("la"), F.col("r"), F.col("lm") == F.col("rm")), 4).alias("similarity"), "candidate_count")
    return near.unionByName(scored)


def samples(rows: DataFrame, counts: DataFrame, limit: int = 5) -> DataFrame:
    """(id, samples): the first rows of each location."""
    rank = F.row_number().over(Window.partitionBy(*KEY).orderBy("row_idx"))
    first = normal_keys(rows).join(counts.select("id", *KEY), KEY).withColumn("rank", rank).where(F.col("rank") <= limit)
    return first.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("rank", "row_idx", "lot"))).alias("samples"))


def items(odd: DataFrame, found: DataFrame, rows: DataFrame, max_items: int = 0, limit: int = 5) -> DataFrame:
    """(place, id, count, reasons, samples, candidates): what is asked about, the rarest locations first and then by id, only
    those that have candidates; of more than `max_items` (0: all) the first."""
    offered = found.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("rank", "candidate", "similarity", "candidate_count"))).alias("candidates"))
    asked = odd.join(offered, "id")
    if max_items:
        asked = asked.orderBy("count", "id").limit(max_items)
    whole = asked.join(samples(rows, asked, limit), "id", "left")
    return in_order(whole.select("id", "count", "reasons", "samples", "candidates"), ["count", "id"], "place")


def deterministic_decisions(odd: DataFrame, found: DataFrame, counts: DataFrame, version: str = D.EARLY) -> DataFrame:
    """(id, action, corrected_id, confidence) for areas with a separator or the prefecture's name in them that equal just
    one of their candidates once separators or a municipality's name are taken out."""
    area = F.col("area")
    marked = odd.where(area.rlike("[,、，]|大阪[府市]"))
    bare = lambda c: F.regexp_replace(c, "^[,、，]+", "")
    cut = [F.when(area.startswith(n) & (area != n), comparable(bare(F.substring(area, len(n) + 1, 1 << 30)))) for n in D.hints(version) if len(n) > 1]
    variants = F.array(F.col("comparable"), comparable(F.regexp_replace(area, "[,、，]", "")), *cut)
    forms = marked.select("id", F.explode(F.array_distinct(F.filter(variants, lambda v: v.isNotNull() & (v != "")))).alias("form"))
    named = found.join(counts.select(F.col("id").alias("candidate"), F.col("comparable").alias("form")), "candidate")
    hits = named.join(forms, ["id", "form"], "left_semi").groupBy("id").agg(F.count("*").alias("n"), F.min("candidate").alias("corrected_id")).where("n = 1")
    return hits.select("id", F.lit("replace").alias("action"), "corrected_id", F.lit(0.99).alias("confidence"))


def remaining(odd: DataFrame, decisions: DataFrame) -> DataFrame:
    """Locations without a decision."""
    return odd.join(decisions.select("id").distinct(), "id", "left_anti")


def fill_missing(odd: DataFrame, decisions: DataFrame) -> DataFrame:
    """Decisions, and a cautious keep for each location that has none."""
    kept = remaining(odd, decisions).select("id", F.lit("keep").alias("action"), F.lit("").alias("corrected_id"), F.lit(0.0).alias("confidence"))
    return decisions.select("id", "action", "corrected_id", "confidence").unionByName(kept)


def too_many_missing(asked: Column, missing: Column) -> Column:
    return missing > F.greatest(F.lit(3), F.floor(asked / 10))


def valid_corrections(decisions: DataFrame, odd: DataFrame, found: DataFrame, counts: DataFrame, min_confidence: float = 0.75, other_municipality: bool = False) -> DataFrame:
    """(id, prefecture, municipality, area): the last valid replacement of each location; a later keep doesn't undo it."""
    wanted = decisions.where((F.col("action") == "replace") & (F.col("confidence") >= min_confidence))
    offered = wanted.join(found.select("id", F.col("candidate").alias("corrected_id")).distinct(), ["id", "corrected_id"])
    place = counts.select(F.col("id").alias("corrected_id"), *[F.col(c).alias(f"new_{c}") for c in KEY])
    both = offered.join(place, "corrected_id").join(odd.select("id", "prefecture", "municipality"), "id")
    if not other_municipality:
        both = both.where("prefecture = new_prefecture AND municipality = new_municipality")
    last = both.groupBy("id").agg(F.max_by(F.struct(*[F.col(f"new_{c}").alias(c) for c in KEY]), "decision_idx").alias("x"))
    return last.select("id", "x.*")


def apply_corrections(rows: DataFrame, corrections: DataFrame) -> DataFrame:
    """rows with corrected locations and `changed`; lots stay, and so do locations without a correction, as they were written.
    Spark broadcasts the corrections if they are small."""
    new = corrections.select("id", *[F.col(c).alias(f"new_{c}") for c in KEY])
    joined = rows.withColumn("id", location_id(*(normalized(F.col(c)) for c in KEY))).join(new, "id", "left")
    fixed = [F.coalesce(F.col(f"new_{c}"), F.col(c)).alias(c) for c in KEY]
    return joined.select("row_idx", *fixed, "lot", F.col("new_area").isNotNull().alias("changed"))


def report(rows: DataFrame, odd: DataFrame, corrections: DataFrame, repaired: DataFrame) -> DataFrame:
    """One row: how many rows, odd locations, corrections and changed rows."""
    one = lambda df, name: df.agg(F.count("*").alias(name))
    parts = [one(rows, "rows"), one(odd, "suspicious"), one(corrections, "corrections"), one(repaired.where("changed"), "changed")]
    out = parts[0]
    for p in parts[1:]:
        out = out.crossJoin(p)  # single rows
    return out
