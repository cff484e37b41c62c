from .columns import (
    blank_to_null,
    clean_range,
    density_band,
    hours_between,
    instant,
    local_to_utc,
    moment,
    nan_to_null,
    null_safe_join,
    segment_tier,
    to_double,
    to_long,
    truncate,
    wall_clock,
)

__all__ = [
    "blank_to_null", "clean_range", "density_band", "hours_between", "instant", "local_to_utc",
    "moment", "nan_to_null", "null_safe_join", "segment_tier", "to_double", "to_long", "truncate", "wall_clock",
]
