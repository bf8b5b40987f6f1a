"""The stages as plans: DataFrames in, DataFrames out, no actions."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame

from dirbook import dictionary as D
from dirbook.operators import export, publish, repair
from dirbook.operators.segments import normalize_responses


class Repair(NamedTuple):
    suspicious: DataFrame
    candidates: DataFrame
    decisions: DataFrame
    repaired: DataFrame


def recognised(responses: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(documents, quarantined) of raw responses(page, column, text)."""
    found = normalize_responses(responses)
    return found.where("error IS NULL").drop("error"), found.where("error IS NOT NULL").drop("segments")


def exported(segments: DataFrame) -> DataFrame:
    return export.export(segments)


def repaired(rows: DataFrame, decisions: DataFrame | None = None, as_of: str = D.EARLY, rare_max: int = 2, common_min: int = 8, min_similarity: float = 0.72, top: int = 8, min_confidence: float = 0.75) -> Repair:
    """The repair stage over rows(row_idx, KEY..., lot). Decisions that are given (replayed) come before deterministic ones."""
    version = D.LATE if as_of >= D.LATE else D.EARLY
    counts = repair.location_counts(rows)
    odd = repair.suspicious(counts, rare_max, version)
    found = repair.candidates(odd, counts, common_min, min_similarity, top)
    offered = odd.join(found.select("id").distinct(), "id", "left_semi")
    own = repair.deterministic_decisions(offered, found, counts, version)
    if decisions is None:
        every = own.selectExpr("0 AS decision_idx", "id", "action", "corrected_id", "confidence")
    else:
        rest = repair.remaining(own, decisions).selectExpr("-1 AS decision_idx", "id", "action", "corrected_id", "confidence")
        every = decisions.select("decision_idx", "id", "action", "corrected_id", "confidence").unionByName(rest)
    corrections = repair.valid_corrections(every, offered, found, counts, min_confidence)
    return Repair(offered, found, every, repair.apply_corrections(rows, corrections))


def published(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows in order, counts of what was skipped) of rows(row_idx, fields)."""
    return publish.publish(rows), publish.skip_counts(rows)
