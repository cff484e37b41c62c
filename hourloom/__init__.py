"""Sensor time-series analytics as PySpark DataFrame operators."""

from .operators.calendar import hourly_spine, periods, periods_of, spine_of
from .operators.clean import canonical_sort, clean, conform, sanitize, stamp_audit
from .operators.coverage import (
    coverage_check, coverage_counts, coverage_matrix, coverage_share, profile, rank_counts,
    rank_parameters, rarest_parameter, top_parameters,
)
from .operators.dedupe import keep_latest
from .operators.enrich import Dim, enrich, sensors_with_dates, wide_measurements
from .operators.filters import active_between, exclude_banned, exclude_ids, in_bbox, is_member
from .operators.flatten import (
    array_to_columns, explode_children, explode_parallel_arrays, flatten_structs,
)
from .operators.grid import dense_grid, pivot_readings, tag_concurrency
from .operators.incremental import changed_days, overwrite_days, plan_refresh, refresh_days, rows_of_days
from .operators.logs import run_log_errors, run_log_summary
from .operators.merge import merge_changes, read_table, upsert_files, upsert_table
from .operators.order import number_in_order, number_rows
from .operators.publish import Output, finish, known_days, publish, replace_table
from .operators.quality import (
    check_accepted, check_at_least_one, check_constraints, check_freshness, check_not_null,
    check_relationship, check_unique,
)
from .operators.reports import (
    density_histogram, duration_report, gap_distribution, gold_locations, mean_by_parameter,
    overlapping_segments, rank_by_average, rank_by_perfect_hours, segment_boundaries,
    segment_timeline, tier_summary, unpivot_values,
)
from .operators.resegment import read_segments, refresh_segments
from .operators.segments import segment, segment_by_series, shatter, track_perfect_hours
from .operators.split import monthly_perfect_hours, split_locations, split_report, split_shares
from .operators.zorder import in_bbox_by_cell, sorted_by_cell, with_cell
from .session import build_session
from .sources.files import (
    concat_files, concat_to, export_query, load_table, read_json_documents, read_run_logs, read_typed,
    run_query, write_parquet, write_reconciled,
)
from .sources.quarantine import concat_widened, inspect_parquet, read_sound
from .specs import LOCATIONS, MEASUREMENTS, SENSORS, SPECS, WEATHER, TableSpec
from .streaming.upsert import stream_upsert
