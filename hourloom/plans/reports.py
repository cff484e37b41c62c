"""The three reports a user asks for, each a dictionary of lazy DataFrames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from ..constants import (
    COVERAGE_THRESHOLD, DENSITY_THRESHOLD, PARAMETER_COLUMNS, TEST_LOCATIONS, TOP_PARAMETERS,
)
from ..operators import coverage as cov
from ..operators import reports as rep
from ..operators import split as spl
from ..sources.landing import landed


def parameter_report(
    df: DataFrame, n: int = TOP_PARAMETERS, threshold: float = COVERAGE_THRESHOLD
) -> dict[str, DataFrame]:
    """Most common parameters, locations that have them all, and their hourly coverage.

    Every part comes from the counts per location and parameter, one row for each, which are kept in the
    shared folder, so the measurements are aggregated once for all parts and never joined. The names of the top ``n`` parameters become columns, so
    those ``n`` values are looked up.
    """
    pairs = landed(cov.coverage_counts(df), "coverage-counts")
    ranking = cov.rank_counts(pairs)
    top = cov.top_parameters(ranking, n)
    names = [r[0] for r in top.select(cov.NAME).collect()]  # at most n names
    checked = cov.coverage_check(pairs, top, n)
    full = checked.filter("coverage = 'full'")
    counts = pairs.filter(pairs[cov.NAME].isin(names)).join(
        full.select("location_id"), "location_id", "left_semi"
    )
    return {
        "ranking": ranking,
        "top": top,
        "coverage": checked,
        "coverage_share": cov.coverage_share(checked),
        "counts": counts,
        "matrix": cov.coverage_matrix(counts, names, threshold),
    }


def segment_report(
    seg: DataFrame, value_cols: Sequence[str] = tuple(PARAMETER_COLUMNS)
) -> dict[str, DataFrame]:
    return {
        "tiers": rep.tier_summary(seg, value_cols),
        "dense_tiers": rep.tier_summary(seg, value_cols, DENSITY_THRESHOLD),
        "overlaps": rep.overlapping_segments(rep.segment_boundaries(seg)),
        "durations": rep.duration_report(seg),
        "gold_locations": rep.gold_locations(seg),
    }


def split_report(seg: DataFrame, test_ids: Sequence = TEST_LOCATIONS, **options):
    gold_ids = rep.gold_locations(seg)
    per_location = spl.split_report(seg, test_ids)
    held_out = seg.filter(spl.is_member("location_id", test_ids))
    return {
        "gold_locations": gold_ids,
        "train_locations": spl.split_locations(gold_ids, test_ids),
        "per_location": per_location,
        "shares": spl.split_shares(per_location, len(test_ids)),
        "timeline": rep.segment_timeline(held_out),
        "monthly": spl.monthly_perfect_hours(seg, test_ids, **options),
    }
