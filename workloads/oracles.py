"""Plain SQL with the same results as the queries, written independently of them."""

from __future__ import annotations

ORACLES: dict[str, str] = {}


def _list(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


def readings(locations: int | None) -> str:
    place = "user_id" if locations is None else f"user_id % {locations}"
    return f"""readings AS (
        SELECT CAST({place} AS VARCHAR) AS location_id, date_trunc('hour', ts) AS datetimeto_utc,
               event_type AS parameter_id, round(avg(value), 6) AS value, event_type AS sensor_name
        FROM events GROUP BY 1, 2, 3)"""


FIVE = ("click", "view", "purchase", "signup", "error")
THREE, TWO = FIVE[:3], FIVE[:2]
TEST_IDS = ("1", "5", "9", "40", "77")


def grid_ctes(locations: int, series, high: float) -> str:
    cells = ", ".join(f"max(CASE WHEN parameter_id = '{s}' THEN value END) AS {s}_value" for s in series)
    names = ", ".join(f"p.{s}_value" for s in series)
    return f"""{readings(locations)},
    cleaned AS (
        SELECT location_id, datetimeto_utc, parameter_id,
               CASE WHEN value < 0 OR value >= {high} THEN NULL ELSE value END AS value
        FROM readings WHERE parameter_id IN ({_list(series)})),
    counted AS (
        SELECT *, count(value) OVER (PARTITION BY location_id, datetimeto_utc) AS concurrent_sensors FROM cleaned),
    pivoted AS (
        SELECT location_id, datetimeto_utc, {cells}, coalesce(max(concurrent_sensors), 0) AS concurrent_sensors
        FROM counted GROUP BY 1, 2),
    spine AS (
        SELECT unnest(generate_series(date_trunc('hour', min(ts)), date_trunc('hour', max(ts)), INTERVAL 1 HOUR)) AS datetimeto_utc
        FROM events),
    grid AS (
        SELECT l.location_id, s.datetimeto_utc, {names}, coalesce(p.concurrent_sensors, 0) AS concurrent_sensors
        FROM (SELECT DISTINCT location_id FROM cleaned) l CROSS JOIN spine s
        LEFT JOIN pivoted p ON p.location_id = l.location_id AND p.datetimeto_utc = s.datetimeto_utc)"""


def island_ctes(needed: int, gap: int = 4) -> str:
    """Islands of perfect hours: an hour more than ``gap`` after the perfect one before it opens a new one.

    Nothing else is known of an island but its first and last hour and how many there are."""
    return f"""perfect AS (SELECT location_id, datetimeto_utc AS h FROM grid WHERE concurrent_sensors = {needed}),
    islands AS (
        SELECT location_id, island AS segments_num, min(h) AS segment_start, max(h) AS segment_end, count(*) AS segment_perfect_hours
        FROM (SELECT *, CAST(count(CASE WHEN opens THEN 1 END) OVER (PARTITION BY location_id ORDER BY h) AS BIGINT) AS island
              FROM (SELECT *, coalesce(h - lag(h) OVER (PARTITION BY location_id ORDER BY h) > INTERVAL {gap} HOUR, TRUE) AS opens FROM perfect) o) i
        GROUP BY 1, 2),
    followed AS (
        SELECT g.*, p.h AS last_perfect_hour, date_diff('hour', p.h, g.datetimeto_utc) AS hours_since_last
        FROM grid g ASOF LEFT JOIN perfect p ON g.location_id = p.location_id AND g.datetimeto_utc > p.h)"""


def attributed(source: str, gold: int, silver: int) -> str:
    """What follows from start, end, perfect hours and number of a segment."""
    return f"""seg AS (
        SELECT *, location_id || '_S' || segments_num AS segment_id, segment_perfect_hours / segment_total_hours AS segment_perfect_density,
            CASE WHEN segment_total_hours < {silver} THEN 'bronze' WHEN segment_total_hours < {gold} THEN 'silver' ELSE 'gold' END AS segment_tier
        FROM (SELECT *, date_diff('hour', segment_start, segment_end) + 1 AS segment_total_hours FROM {source}) x)"""


def seg_ctes(locations, series, high, perfect, gold, silver) -> str:
    names = ", ".join(f"{s}_value" for s in series)
    return f"""WITH {grid_ctes(locations, series, high)}, {island_ctes(perfect)},
    counted_islands AS (SELECT *, count(*) OVER (PARTITION BY location_id) AS segments_total FROM islands),
    members AS (
        SELECT location_id, datetimeto_utc, hours_since_last, concurrent_sensors, CAST(datetimeto_utc = segment_start AS INTEGER) AS is_new_segment,
            {names}, segment_start, segment_end, segment_perfect_hours, segments_num, segments_total
        FROM counted_islands JOIN followed USING (location_id) WHERE datetimeto_utc BETWEEN segment_start AND segment_end),
    {attributed('members', gold, silver)}"""


GRID = f"WITH {grid_ctes(2, THREE, 100)}"
CITY = seg_ctes(2, THREE, 100, 3, 24, 8)
MANY = seg_ctes(64, THREE, 10000, 1, 2, 1)
DEFAULT = seg_ctes(16, TWO, 10000, 2, 336, 168)
ALL_READINGS = f"WITH {readings(None)}"
PLACES = """places AS (
    SELECT CAST(c_custkey % 64 AS VARCHAR) AS location_id, min(c_acctbal) AS location_latitude,
           max(c_acctbal) AS location_longitude FROM customer GROUP BY 1)"""
BOUNDARIES = """SELECT location_id, segment_id, segments_num, min(datetimeto_utc) AS segment_start,
    max(datetimeto_utc) AS segment_end FROM seg GROUP BY 1, 2, 3"""

# Readings, cleaning, concurrency, pivot, grid -------------------------------------------------
ORACLES["sensor_readings"] = f"WITH {readings(2)} SELECT * FROM readings"
ORACLES["range_clean"] = """
    SELECT event_id, CASE WHEN value < 5 OR value >= 100 THEN NULL ELSE value END AS value FROM events"""
ORACLES["static_filter"] = f"""{ALL_READINGS}
    SELECT location_id, datetimeto_utc, parameter_id, sensor_name,
           CASE WHEN value < 0 OR value >= 100 THEN NULL ELSE value END AS value
    FROM readings WHERE datetimeto_utc >= TIMESTAMP '2024-01-10 00:00:00' AND parameter_id IN ({_list(THREE)})"""
ORACLES["concurrency"] = f"{GRID} SELECT *, parameter_id AS sensor_name FROM counted"
ORACLES["concurrency_raw_events"] = """
    SELECT event_id, event_type, value, count(value) OVER (PARTITION BY event_type) AS concurrent_sensors FROM events"""
ORACLES["parameter_pivot"] = f"""WITH {readings(2)}
    SELECT location_id, datetimeto_utc, {", ".join(f"max(CASE WHEN parameter_id = '{s}' THEN value END) AS {s}_value" for s in THREE)},
           count(value) AS concurrent_sensors
    FROM readings GROUP BY 1, 2"""
ORACLES["parameter_pivot_distinct"] = f"""
    SELECT user_id AS location_id, date_trunc('day', ts)::TIMESTAMP AS datetimeto_utc,
           {", ".join(f"max(CASE WHEN event_type = '{s}' THEN value END) AS {s}_value" for s in THREE)},
           count(DISTINCT CASE WHEN event_type IN ({_list(THREE)}) THEN event_type END) AS concurrent_sensors
    FROM events GROUP BY 1, 2"""
ORACLES["time_spine"] = f"{GRID} SELECT datetimeto_utc FROM spine"
ORACLES["hours_in_range"] = """
    SELECT user_id, CAST(floor((epoch_us(date_trunc('second', max(ts))) - epoch_us(date_trunc('second', min(ts)))) / 3600000000) AS BIGINT) + 1 AS hour_count
    FROM events GROUP BY 1"""
for _grain, _n in (("month", 1), ("quarter", 3)):
    ORACLES[f"calendar_{_grain}s"] = f"""
        SELECT CAST(year(p) AS INTEGER) AS year, CAST({_grain}(p) AS INTEGER) AS period, p AS period_start,
               p + INTERVAL {_n} MONTH - INTERVAL 1 SECOND AS period_end,
               (SELECT count(*) FROM orders WHERE o_orderdate >= p AND o_orderdate < p + INTERVAL {_n} MONTH) AS order_count
        FROM (SELECT unnest(generate_series(date_trunc('year', min(o_orderdate)),
              date_trunc('year', max(o_orderdate)) + INTERVAL 11 MONTH, INTERVAL {_n} MONTH)) AS p FROM orders) q
        WHERE year(p) IN (SELECT DISTINCT year(o_orderdate) FROM orders)"""
ORACLES["distinct_locations"] = "SELECT DISTINCT CAST(user_id AS VARCHAR) AS location_id FROM events"
ORACLES["dense_grid"] = f"{GRID} SELECT * FROM grid"

# Segments -------------------------------------------------------------------------------------
ORACLES["perfect_hour_tracking"] = f"""{GRID}, {island_ctes(3)}
    SELECT f.*, CAST(concurrent_sensors = 3 AS INTEGER) AS is_perfect_hour, first_perfect_hour
    FROM followed f LEFT JOIN (SELECT location_id, min(h) AS first_perfect_hour FROM perfect GROUP BY 1) m USING (location_id)"""
# a segment's rows before its tail is cut: up to four hours after its last perfect one
ORACLES["segment_numbering"] = f"""{GRID}, {island_ctes(3)}
    SELECT location_id, datetimeto_utc, CAST(concurrent_sensors = 3 AS INTEGER) AS is_perfect_hour, hours_since_last,
        CAST(datetimeto_utc = segment_start AS INTEGER) AS is_new_segment, segments_num
    FROM islands JOIN followed USING (location_id) WHERE datetimeto_utc BETWEEN segment_start AND segment_end + INTERVAL 4 HOUR"""
ORACLES["segments"] = f"{CITY} SELECT * FROM seg"
ORACLES["segments_chunked"] = ORACLES["segments"]
ORACLES["segments_resumed"] = ORACLES["segments"]
ORACLES["segments_minutes"] = f"""WITH slots AS (
        SELECT CAST(user_id % 2 AS VARCHAR) AS location_id, time_bucket(INTERVAL 15 MINUTE, ts) AS datetimeto_utc, max(value) AS top_value,
            count(DISTINCT event_type) AS concurrent_sensors
        FROM events GROUP BY 1, 2),
    grid AS (
        SELECT l.location_id, t.datetimeto_utc, s.top_value, coalesce(s.concurrent_sensors, 0) AS concurrent_sensors
        FROM (SELECT DISTINCT location_id FROM slots) l
        CROSS JOIN (SELECT unnest(generate_series(date_trunc('hour', min(ts)), date_trunc('hour', max(ts)), INTERVAL 15 MINUTE)) AS datetimeto_utc FROM events) t
        LEFT JOIN slots s ON s.location_id = l.location_id AND s.datetimeto_utc = t.datetimeto_utc),
    {island_ctes(2).replace("h - lag(h) OVER (PARTITION BY location_id ORDER BY h) > INTERVAL 4 HOUR", "date_diff('hour', lag(h) OVER (PARTITION BY location_id ORDER BY h), h) > 4")},
    members AS (
        SELECT location_id, datetimeto_utc, hours_since_last, concurrent_sensors, CAST(datetimeto_utc = segment_start AS INTEGER) AS is_new_segment,
            top_value, segment_start, segment_end, segment_perfect_hours, segments_num, (SELECT count(*) FROM islands i WHERE i.location_id = followed.location_id) AS segments_total
        FROM islands JOIN followed USING (location_id) WHERE datetimeto_utc BETWEEN segment_start AND segment_end),
    {attributed('members', 24, 8)}
    SELECT * FROM seg"""
ORACLES["segments_of_five_series"] = seg_ctes(2, FIVE, 100, 5, 24, 8) + " SELECT * FROM seg"
ORACLES["segments_default_tiers"] = f"{DEFAULT} SELECT * FROM seg"
# Each hour up to the leading series' first report is a segment of its own; the last of these goes on for as long as every
# series that has reported at all did so within three hours. So a number is a count of hours since the spine began.
_asof = " ".join(
    f"ASOF LEFT JOIN (SELECT location_id, datetimeto_utc AS h FROM grid WHERE {s}_value IS NOT NULL) {s} ON g.location_id = {s}.location_id AND g.datetimeto_utc > {s}.h"
    for s in THREE
)
_silent = ", ".join(f"coalesce(date_diff('hour', {s}.h, g.datetimeto_utc), 0)" for s in THREE)
ORACLES["segments_strategy_b"] = f"""{GRID},
    silent AS (SELECT g.*, greatest({_silent}) AS hours_since_last FROM grid g {_asof}),
    led AS (
        SELECT s.*, date_diff('hour', (SELECT min(datetimeto_utc) FROM spine), least(datetimeto_utc, coalesce(lead, datetimeto_utc))) + 1 AS segments_num,
            lead IS NULL OR datetimeto_utc <= lead AS waits
        FROM silent s LEFT JOIN (SELECT location_id, min(datetimeto_utc) AS lead FROM grid WHERE click_value IS NOT NULL GROUP BY 1) l USING (location_id)),
    lasting AS (SELECT * FROM led WHERE waits OR hours_since_last <= 3),
    totals AS (
        SELECT location_id, segments_num, min(datetimeto_utc) AS segment_start, max(datetimeto_utc) AS segment_end,
            count(CASE WHEN concurrent_sensors = 3 THEN 1 END) AS segment_perfect_hours
        FROM lasting GROUP BY 1, 2),
    members AS (
        SELECT location_id, datetimeto_utc, hours_since_last, concurrent_sensors, CAST(waits AS INTEGER) AS is_new_segment,
            {", ".join(f"{s}_value" for s in THREE)}, segment_start, segment_end, segment_perfect_hours, segments_num,
            (SELECT count(*) FROM totals t WHERE t.location_id = lasting.location_id) AS segments_total
        FROM lasting JOIN totals USING (location_id, segments_num)),
    {attributed('members', 24, 8)}
    SELECT * FROM seg"""
ORACLES["segment_boundaries"] = f"{CITY} {BOUNDARIES}"
_overlap = """SELECT *, date_diff('hour', prev_segment_end, segment_start) AS hours_since_prev_segment_end,
        segment_start < prev_segment_end AS is_overlapping
    FROM (SELECT *, lag(segment_end) OVER (PARTITION BY location_id ORDER BY segment_start, segment_end, segment_id) AS prev_segment_end FROM bounds) z
    WHERE segment_start < prev_segment_end"""
ORACLES["segment_overlap"] = f"{CITY}, bounds AS ({BOUNDARIES}) {_overlap}"
ORACLES["overlap_of_orders"] = f"""WITH bounds AS (
        SELECT o_custkey AS location_id, o_orderkey AS segment_id, min(o_orderdate) AS segment_start, max(l_shipdate) AS segment_end
        FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1, 2)
    {_overlap}"""

# Segment reports ------------------------------------------------------------------------------
_nulls = " + ".join(f"CASE WHEN {s}_value IS NULL THEN 1 ELSE 0 END" for s in THREE)


def _tiers(where: str) -> str:
    return f"""
    SELECT CASE WHEN GROUPING(segment_tier) = 1 THEN 'all' ELSE segment_tier END AS segment_tier, count(*) AS row_count,
        CAST(sum({_nulls}) AS BIGINT) AS null_count, CAST(sum({_nulls}) AS BIGINT) / count(*) AS null_ratio,
        count(DISTINCT segment_id) AS segment_count
    FROM seg {where} GROUP BY ROLLUP (segment_tier)"""


ORACLES["tier_summary"] = CITY + _tiers("")
ORACLES["tier_summary_dense"] = CITY + _tiers("WHERE segment_perfect_density >= 0.9")


def _durations(steps) -> str:
    return f"""
    , one AS (SELECT segment_id, max(segment_total_hours) AS h FROM seg GROUP BY 1),
    whole AS (SELECT (date_diff('hour', min(datetimeto_utc), max(datetimeto_utc)) + 1) * count(DISTINCT location_id) AS m FROM seg),
    steps AS (SELECT unnest([0, {", ".join(map(str, steps))}]) AS s)
    SELECT CAST(s AS INTEGER) AS min_hours, CAST(coalesce(sum(CASE WHEN h >= s THEN h END), 0) AS BIGINT) AS total_hours,
        any_value(m) AS maximum_potential, CAST(coalesce(sum(CASE WHEN h >= s THEN h END), 0) AS BIGINT) / any_value(m) AS hours_share,
        count(CASE WHEN h >= s THEN 1 END) AS segment_count, count(*) AS total_segments,
        count(CASE WHEN h >= s THEN 1 END) / count(*) AS segment_share
    FROM one, whole, steps GROUP BY s"""


ORACLES["duration_report"] = CITY + _durations((4, 8, 24, 48))
ORACLES["duration_report_default_steps"] = DEFAULT + _durations((48, 72, 168, 336))
ORACLES["gold_locations"] = f"{MANY} SELECT DISTINCT location_id FROM seg WHERE segment_tier = 'gold'"
ORACLES["gold_locations_dense"] = f"""{MANY}
    SELECT DISTINCT location_id FROM seg WHERE segment_tier = 'gold' AND segment_perfect_density >= 0.9"""


def _timeline(where: str) -> str:
    return f"""
    , one AS (SELECT location_id, segment_id, min(segment_start) AS segment_start, max(segment_total_hours) AS segment_total_hours,
              max(segment_perfect_density) AS segment_perfect_density, max(segments_total) AS st
              FROM seg WHERE segment_tier = 'gold' {where} GROUP BY 1, 2)
    SELECT location_id, segment_id, segment_start, segment_total_hours, segment_perfect_density,
        CASE WHEN segment_perfect_density >= 0.9 THEN 'high' WHEN segment_perfect_density >= 0.8 THEN 'medium' ELSE 'low' END AS density_band,
        count(*) OVER (PARTITION BY location_id) AS gold_segments, max(st) OVER (PARTITION BY location_id) AS segments_total
    FROM one"""


ORACLES["segment_timeline"] = MANY + _timeline("")
ORACLES["segment_timeline_dates"] = MANY + _timeline(
    "AND datetimeto_utc >= TIMESTAMP '2024-01-05 00:00:00' AND datetimeto_utc < TIMESTAMP '2024-01-20 00:00:00'"
)
ORACLES["density_histogram"] = f"""{CITY},
    one AS (SELECT segment_id, max(segment_perfect_density) AS d FROM seg GROUP BY 1),
    ends AS (SELECT CASE WHEN min(d) = max(d) THEN min(d) - 0.5 ELSE min(d) END AS lo,
                    CASE WHEN min(d) = max(d) THEN max(d) + 0.5 ELSE max(d) END AS hi FROM one),
    hits AS (SELECT least(CAST(floor(20 * (d - lo) / (hi - lo)) AS INTEGER) + 1, 20) AS bin, count(*) AS n FROM one, ends GROUP BY 1)
    SELECT CAST(b.bin AS INTEGER) AS bin, round(lo + (hi - lo) / 20 * (b.bin - 1), 6) AS bin_start,
           round(lo + (hi - lo) / 20 * b.bin, 6) AS bin_end, coalesce(n, 0) AS segment_count
    FROM (SELECT unnest(generate_series(1, 20)) AS bin) b CROSS JOIN ends LEFT JOIN hits ON hits.bin = b.bin"""
_ranking = f"""{MANY}, {PLACES},
    ranked AS (
        SELECT location_id, count(CASE WHEN concurrent_sensors = 1 THEN 1 END) AS location_perfect_hours, count(*) AS location_total_hours
        FROM seg WHERE segment_tier = 'gold' GROUP BY 1)"""
ORACLES["perfect_hours_ranking"] = f"""{_ranking}
    SELECT r.*, location_perfect_hours / location_total_hours AS location_perfect_density,
           location_latitude, location_longitude, pow(location_perfect_hours, 2) AS marker_size,
           CAST(row_number() OVER (ORDER BY location_perfect_hours DESC, r.location_id) AS INTEGER) AS position
    FROM ranked r JOIN places p ON r.location_id = p.location_id"""
ORACLES["location_type_flag"] = f"""{_ranking}
    SELECT r.location_id, r.location_id IN ({_list(TEST_IDS)}) AS location_type FROM ranked r JOIN places p ON r.location_id = p.location_id"""
_long = " UNION ALL ".join(
    f"SELECT location_id, datetimeto_utc, '{s}_value' AS sensor_name, {s}_value AS value, segment_tier FROM seg WHERE {s}_value IS NOT NULL"
    for s in THREE
)
ORACLES["unpivot_values"] = f"{MANY} SELECT location_id, datetimeto_utc, sensor_name, value FROM ({_long}) u"
# means over whole millionths: a mean of doubles changes in its last digits with the order of the rows
_means = f"""{MANY}, means AS (
    SELECT location_id, sensor_name, avg(CAST(round(value * 1000000) AS BIGINT)) / 1000000 AS avg_val FROM ({_long}) u WHERE segment_tier = 'gold' GROUP BY 1, 2)"""
ORACLES["mean_by_parameter"] = f"{_means} SELECT * FROM means"
ORACLES["average_ranking_top20"] = f"""{_means}
    SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY sensor_name ORDER BY avg_val DESC, location_id) AS INTEGER) AS rank FROM means) r
    WHERE rank <= 20"""
ORACLES["train_locations"] = f"""{MANY}
    SELECT DISTINCT location_id FROM seg WHERE segment_tier = 'gold' AND location_id NOT IN ({_list(TEST_IDS)})"""
_split = f"""{MANY}, report AS (
    SELECT location_id,
        CAST(sum(CASE WHEN location_id NOT IN ({_list(TEST_IDS)}) THEN 1 ELSE 0 END) AS BIGINT) AS train_measurements,
        CAST(sum(CASE WHEN location_id IN ({_list(TEST_IDS)}) THEN 1 ELSE 0 END) AS BIGINT) AS test_measurements,
        count(*) AS total_measurements
    FROM seg WHERE segment_tier = 'gold' GROUP BY 1)"""
ORACLES["split_report"] = f"{_split} SELECT * FROM report"
ORACLES["split_shares"] = f"""{_split},
    sums AS (SELECT count(*) AS n, count(CASE WHEN train_measurements > 0 THEN 1 END) AS tn, CAST(sum(train_measurements) AS BIGINT) AS tr,
             CAST(sum(test_measurements) AS BIGINT) AS te, CAST(sum(total_measurements) AS BIGINT) AS al FROM report)
    SELECT 'train' AS split, tn AS locations, n AS total_locations, tn / n AS location_share, tr AS measurements,
           al AS total_measurements, tr / al AS measurement_share FROM sums
    UNION ALL SELECT 'test', CAST({len(TEST_IDS)} AS BIGINT), n, {len(TEST_IDS)} / n, te, al, te / al FROM sums"""
ORACLES["monthly_perfect_hours"] = f"""{MANY}
    SELECT location_id, strftime(datetimeto_utc, '%Y-%m') AS month, count(*) AS perfect_hours FROM seg
    WHERE segment_tier = 'gold' AND concurrent_sensors = 1 AND location_id IN ({_list(TEST_IDS)}) GROUP BY 1, 2"""
ORACLES["gap_distribution"] = f"""{ALL_READINGS}
    SELECT gap AS hours_since_prev, count(*) AS gap_count FROM (
        SELECT date_diff('hour', lag(datetimeto_utc) OVER (PARTITION BY location_id, sensor_name ORDER BY datetimeto_utc), datetimeto_utc) AS gap
        FROM readings) g
    WHERE gap BETWEEN 6 AND 10000 GROUP BY 1"""
ORACLES["segment_report_overview"] = f"""{CITY}, bounds AS ({BOUNDARIES})
    SELECT 'overlaps' AS part, 'all' AS item, count(*) AS value FROM ({_overlap}) o
    UNION ALL SELECT 'segments', coalesce(segment_tier, 'all'), count(DISTINCT segment_id) FROM seg GROUP BY ROLLUP (segment_tier)
    UNION ALL SELECT 'dense segments', coalesce(segment_tier, 'all'), count(DISTINCT segment_id) FROM seg WHERE segment_perfect_density >= 0.9 GROUP BY ROLLUP (segment_tier)
    UNION ALL SELECT 'hours', CAST(s AS VARCHAR), CAST(coalesce(sum(CASE WHEN h >= s THEN h END), 0) AS BIGINT)
              FROM (SELECT segment_id, max(segment_total_hours) AS h FROM seg GROUP BY 1) one,
                   (SELECT unnest([0, 48, 72, 168, 336]) AS s) steps GROUP BY s
    UNION ALL SELECT 'gold locations', 'all', count(DISTINCT location_id) FROM seg WHERE segment_tier = 'gold'"""
ORACLES["split_report_overview"] = f"""{_split}
    SELECT 'gold_locations' AS part, count(*) AS row_count FROM report
    UNION ALL SELECT 'train_locations', count(*) FROM report WHERE train_measurements > 0
    UNION ALL SELECT 'per_location', count(*) FROM report
    UNION ALL SELECT 'shares', count(*) FROM (VALUES (1), (2)) v
    UNION ALL SELECT 'timeline', count(DISTINCT segment_id) FROM seg WHERE segment_tier = 'gold' AND location_id IN ({_list(TEST_IDS)})
    UNION ALL SELECT 'monthly', count(*) FROM (SELECT DISTINCT location_id, date_trunc('month', datetimeto_utc) FROM seg
        WHERE segment_tier = 'gold' AND concurrent_sensors = 1 AND location_id IN ({_list(TEST_IDS)})) m"""

ORACLES["segment_report_tiers"] = ORACLES["tier_summary"]
ORACLES["segment_report_dense_tiers"] = ORACLES["tier_summary_dense"]
ORACLES["segment_report_overlaps"] = ORACLES["segment_overlap"]
ORACLES["segment_report_durations"] = CITY + _durations((48, 72, 168, 336))
ORACLES["segment_report_gold_locations"] = f"{CITY} SELECT DISTINCT location_id FROM seg WHERE segment_tier = 'gold'"
ORACLES["split_report_gold_locations"] = ORACLES["gold_locations"]
ORACLES["split_report_train_locations"] = ORACLES["train_locations"]
ORACLES["split_report_per_location"] = ORACLES["split_report"]
ORACLES["split_report_shares"] = ORACLES["split_shares"]
ORACLES["split_report_timeline"] = MANY + _timeline(f"AND location_id IN ({_list(TEST_IDS)})")
ORACLES["split_report_monthly"] = ORACLES["monthly_perfect_hours"]

# Parameter coverage ---------------------------------------------------------------------------
_ranked = f"""{ALL_READINGS},
    ranking AS (SELECT sensor_name, count(DISTINCT location_id) AS location_count, count(*) AS measurement_count FROM readings GROUP BY 1),
    top AS (SELECT * FROM ranking ORDER BY location_count DESC, measurement_count DESC, sensor_name LIMIT 3),
    rarest AS (SELECT * FROM top ORDER BY location_count, measurement_count, sensor_name DESC LIMIT 1)"""
_checked = f"""{_ranked}, checked AS (
    SELECT location_id, count(DISTINCT sensor_name) AS pollutant_count,
           CASE WHEN count(DISTINCT sensor_name) = 3 THEN 'full' ELSE 'partial' END AS coverage
    FROM readings WHERE sensor_name IN (SELECT sensor_name FROM top)
      AND location_id IN (SELECT location_id FROM readings WHERE sensor_name = (SELECT sensor_name FROM rarest)) GROUP BY 1)"""
_counts = "SELECT location_id, sensor_name, count(*) AS measurement_count, min(datetimeto_utc) AS min_datetime, max(datetimeto_utc) AS max_datetime FROM readings"
ORACLES["parameter_ranking"] = f"""{_ranked}
    SELECT *, CAST(row_number() OVER (ORDER BY location_count DESC, measurement_count DESC, sensor_name) AS INTEGER) AS position FROM ranking"""
ORACLES["top_parameters"] = f"{_ranked} SELECT * FROM top"
ORACLES["rarest_parameter"] = f"{_ranked} SELECT * FROM rarest"
ORACLES["coverage_check"] = f"{_checked} SELECT * FROM checked"
ORACLES["coverage_share"] = f"""{_checked}
    SELECT count(CASE WHEN coverage = 'full' THEN 1 END) AS full_locations, count(*) AS total_locations,
           count(CASE WHEN coverage = 'full' THEN 1 END) / count(*) AS full_share FROM checked"""
ORACLES["parameter_report_ranking"] = ORACLES["parameter_ranking"]
ORACLES["parameter_report_top"] = ORACLES["top_parameters"]
ORACLES["parameter_report_coverage"] = ORACLES["coverage_check"]
ORACLES["parameter_report_share"] = ORACLES["coverage_share"]
ORACLES["coverage_counts"] = f"{ALL_READINGS} {_counts} GROUP BY 1, 2"
ORACLES["parameter_report"] = f"""{_checked} {_counts}
    WHERE sensor_name IN (SELECT sensor_name FROM top)
      AND location_id IN (SELECT location_id FROM checked WHERE coverage = 'full') GROUP BY 1, 2"""
_series = ("click", "view", "purchase", "signup", "error")
_shares = ", ".join(
    f"count(CASE WHEN sensor_name = '{s}' THEN 1 END) / (SELECT date_diff('hour', min(datetimeto_utc), max(datetimeto_utc)) + 1 FROM readings) AS {s}"
    for s in _series
)
ORACLES["coverage_matrix"] = f"""WITH {readings(2)}, shares AS (SELECT location_id, {_shares} FROM readings GROUP BY 1)
    SELECT location_id, {", ".join(f"round({s}, 9) AS {s}" for s in _series)}, round(({" + ".join(_series)}) / 5, 9) AS average,
           round(least({", ".join(_series)}), 9) AS minimum, least({", ".join(_series)}) >= 0.5 AS kept FROM shares"""
ORACLES["parameter_report_matrix"] = ORACLES["coverage_matrix"]
ORACLES["dataset_profile"] = f"""{ALL_READINGS}
    SELECT count(*) AS total_rows, min(datetimeto_utc) AS min_datetime, max(datetimeto_utc) AS max_datetime,
           count(DISTINCT location_id) AS unique_locations, count(DISTINCT sensor_name) AS unique_pollutants,
           'datetimeto_utc' AS time_column FROM readings"""
ORACLES["dataset_parameters"] = "SELECT DISTINCT event_type AS sensor_name FROM events"

# Deduplication, staging, enrichment -----------------------------------------------------------
ORACLES["keep_latest"] = """
    SELECT * FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
        ORDER BY l_shipdate DESC, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus) = 1"""
ORACLES["enrich_dims"] = """
    SELECT l_orderkey, l_linenumber, l_quantity, o_custkey, o_orderstatus, c_name, c_nationkey, n_name, n_regionkey, r_name
    FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN customer ON o_custkey = c_custkey
    LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey"""
_staged = """staged AS (
    SELECT CAST(l_orderkey AS VARCHAR) AS sensor_id, l_quantity AS value, CAST(l_partkey AS VARCHAR) AS parameter_id,
        l_returnflag AS parameter_name, l_linestatus AS parameter_units, l_shipdate AS datetimeto_utc, l_shipdate AS datetimeto_local,
        l_shipdate AS ingested_at, l_shipdate + to_hours(l_linenumber) AS updated_at, l_shipdate + to_hours(l_linenumber) AS refreshed_at
    FROM lineitem
    QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_shipdate
        ORDER BY l_linenumber DESC, l_quantity, CAST(l_partkey AS VARCHAR), l_returnflag, l_linestatus) = 1)"""
_sensors = """sensors AS (
    SELECT CAST(o_orderkey AS VARCHAR) AS id, CAST(o_custkey AS VARCHAR) AS location_id, o_orderpriority AS sensor_name,
        CAST(NULL AS VARCHAR) AS parameter_id, CAST(NULL AS VARCHAR) AS parameter_name, CAST(NULL AS VARCHAR) AS parameter_units,
        o_orderstatus AS parameter_displayname, o_orderdate AS ingested_at, o_orderdate AS updated_at, o_orderdate AS refreshed_at
    FROM orders)"""
_places = """locations AS (
    SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS location_name, CAST(NULL AS VARCHAR) AS locality, 'Asia/Seoul' AS timezone,
        c_acctbal < 0 AS ismobile, c_mktsegment = 'MACHINERY' AS ismonitor,
        CASE WHEN c_nationkey % 2 = 0 THEN c_acctbal END AS distance,
        c_acctbal AS bounds_min_lon, c_acctbal + 1 AS bounds_min_lat, c_acctbal + 2 AS bounds_max_lon, c_acctbal + 3 AS bounds_max_lat,
        CAST(n_nationkey AS VARCHAR) AS country_id, c_mktsegment AS country_code, n_name AS country_name,
        CAST(n_regionkey AS VARCHAR) AS owner_id, CAST(NULL AS VARCHAR) AS owner_name,
        CAST(c_nationkey AS VARCHAR) AS provider_id, c_mktsegment AS provider_name,
        c_acctbal / 100 AS coordinates_latitude, c_acctbal / 50 AS coordinates_longitude,
        a AS datetimefirst_utc, a AS datetimefirst_local, b AS datetimelast_utc, b AS datetimelast_local,
        TIMESTAMP '2024-02-01 00:00:00' AS ingested_at, TIMESTAMP '2024-02-01 00:00:00' AS updated_at, TIMESTAMP '2024-02-01 00:00:00' AS refreshed_at
    FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
    LEFT JOIN (SELECT o_custkey, min(o_orderdate) AS a, max(o_orderdate) AS b FROM orders GROUP BY 1) d ON c_custkey = o_custkey)"""
ORACLES["stage_measurements"] = f"WITH {_staged} SELECT * FROM staged"
ORACLES["stage_sensors"] = f"WITH {_sensors} SELECT * FROM sensors"
ORACLES["stage_locations"] = f"WITH {_places} SELECT * FROM locations"
ORACLES["ingest_locations"] = f"""WITH {_places}
    SELECT * RENAME (location_name AS name, ismobile AS "isMobile", ismonitor AS "isMonitor",
        datetimefirst_utc AS "datetimeFirst_utc", datetimefirst_local AS "datetimeFirst_local",
        datetimelast_utc AS "datetimeLast_utc", datetimelast_local AS "datetimeLast_local") FROM locations"""
_hours = """hours AS (
    SELECT vec_id, label, TIMESTAMP '2024-01-01 00:00:00' + to_days(CAST(label AS INTEGER)) + to_hours(CAST(i - 1 AS INTEGER)) AS t,
           CAST(embedding[i] AS DOUBLE) AS v
    FROM (SELECT *, unnest(generate_series(1, len(embedding))) AS i FROM embeddings) e)"""
_staged_weather = """SELECT CAST(vec_id AS VARCHAR) AS location_id, t - INTERVAL 9 HOUR AS datetimeto_utc, t AS datetimeto_local,
        CAST(label AS DOUBLE) AS weather_latitude, CAST(label + 0.5 AS DOUBLE) AS weather_longitude, 'Asia/Seoul' AS timezone,
        CAST(10 AS DOUBLE) AS elevation, {metrics}, {stamps} FROM hours"""
# fixed values: the metrics in the order of the table, whole numbers marked
_metrics = (
    "temperature_2m relative_humidity_2m! dew_point_2m apparent_temperature precipitation rain snowfall snow_depth shortwave_radiation "
    "direct_radiation diffuse_radiation global_tilted_irradiance direct_normal_irradiance terrestrial_radiation weather_code! pressure_msl "
    "surface_pressure cloud_cover! cloud_cover_low! cloud_cover_mid! cloud_cover_high! vapour_pressure_deficit et0_fao_evapotranspiration "
    "wind_speed_100m wind_speed_10m wind_direction_10m! wind_direction_100m! wind_gusts_10m is_day!"
).split()


def _weather(temperature: str, ingested: str, updated: str) -> str:
    known = {"temperature_2m": temperature, "is_day": "CAST(CASE WHEN v > 0 THEN 1 ELSE 0 END AS BIGINT)"}
    cells = [
        f"{known.get(m.rstrip('!'), 'CAST(NULL AS BIGINT)' if m.endswith('!') else 'CAST(NULL AS DOUBLE)')} AS {m.rstrip('!')}" for m in _metrics
    ]
    stamps = f"{ingested} AS ingested_at, {updated} AS updated_at, {{refreshed}} AS refreshed_at"
    return f"WITH {_hours} " + _staged_weather.format(metrics=", ".join(cells), stamps=stamps)


ORACLES["stage_weather"] = _weather("v", "TIMESTAMP '2024-02-01'", "TIMESTAMP '2024-02-01 01:00:00'").format(refreshed="TIMESTAMP '2024-02-01'")
_changed = "t >= TIMESTAMP '2024-01-08'"
_touch = f"CASE WHEN {_changed} THEN TIMESTAMP '2024-01-10' ELSE TIMESTAMP '2024-01-09' END"
ORACLES["refresh_staged_weather"] = _weather(f"CASE WHEN {_changed} THEN v + 1 ELSE v END", "TIMESTAMP '2024-01-09'", _touch).format(refreshed=_touch)
ORACLES["explode_parallel_arrays"] = f"""WITH {_hours}
    SELECT vec_id AS location_id, t - INTERVAL 9 HOUR AS datetimeto_utc, t AS datetimeto_local, CAST(label AS DOUBLE) AS weather_latitude,
           CAST(label + 0.5 AS DOUBLE) AS weather_longitude, 'Asia/Seoul' AS timezone, CAST(10 AS DOUBLE) AS elevation, v AS temperature_2m,
           CAST(CASE WHEN v > 0 THEN 1 ELSE 0 END AS DOUBLE) AS is_day FROM hours"""
ORACLES["standardize_measurements"] = f"""WITH {_staged}, {_sensors}, {_places}
    SELECT s.location_id, m.sensor_id, m.value, s.sensor_name, m.parameter_id, m.parameter_name, m.parameter_units, s.parameter_displayname,
        m.datetimeto_utc, m.datetimeto_local, l.timezone, l.location_name, l.coordinates_latitude AS location_latitude,
        l.coordinates_longitude AS location_longitude, l.ismobile, l.ismonitor, l.datetimefirst_utc, l.datetimelast_utc, l.country_name,
        l.owner_name, l.provider_name, m.ingested_at, m.updated_at, m.refreshed_at
    FROM staged m LEFT JOIN sensors s ON m.sensor_id = s.id LEFT JOIN locations l ON s.location_id = l.id"""
ORACLES["wide_enrichment"] = f"""WITH {_sensors}, {_places}
    SELECT s.location_id, CAST(m.l_orderkey AS VARCHAR) AS sensor_id, s.sensor_name AS name, m.l_quantity AS value,
        CAST(m.l_partkey AS VARCHAR) AS parameter_id, m.l_returnflag AS parameter_name, m.l_linestatus AS parameter_units,
        s.parameter_displayname AS "parameter_displayName", m.l_shipdate - INTERVAL 1 HOUR AS "period_datetimeFrom_local",
        m.l_shipdate AS "period_datetimeTo_local", m.l_shipdate - INTERVAL 1 HOUR AS "period_datetimeFrom_utc", m.l_shipdate AS "period_datetimeTo_utc",
        l.datetimefirst_utc AS "location_datetimeFirst_utc", l.datetimelast_utc AS "location_datetimeLast_utc",
        l.coordinates_latitude, l.coordinates_longitude, l.location_name, l.ismobile AS "isMobile", l.ismonitor AS "isMonitor",
        l.country_id, l.country_code, l.country_name, l.owner_id, l.owner_name, l.provider_id, l.provider_name,
        m.l_suppkey AS "coverage_expectedCount", CAST(m.l_linenumber AS BIGINT) AS "coverage_observedCount"
    FROM lineitem m LEFT JOIN sensors s ON CAST(m.l_orderkey AS VARCHAR) = s.id LEFT JOIN locations l ON s.location_id = l.id"""
ORACLES["active_window"] = """
    SELECT * FROM (SELECT o_custkey, min(o_orderdate) AS first_order, max(o_orderdate) AS last_order FROM orders GROUP BY 1) s
    WHERE last_order >= TIMESTAMP '2001-06-01 00:00:00' AND first_order <= TIMESTAMP '2001-07-01 00:00:00'"""
ORACLES["sensors_of_active_locations"] = f"""WITH {_sensors}, {_places}
    SELECT s.id, s.location_id, s.sensor_name AS name, l.datetimefirst_utc AS "datetimeFirst_utc", l.datetimelast_utc AS "datetimeLast_utc"
    FROM sensors s JOIN locations l ON s.location_id = l.id
    WHERE l.datetimelast_utc >= TIMESTAMP '2001-07-01 00:00:00' AND l.datetimefirst_utc <= TIMESTAMP '1995-02-01 00:00:00'"""
ORACLES["exclude_listed"] = """
    SELECT event_id, user_id, value FROM events WHERE user_id NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)"""
ORACLES["exclude_banned"] = "SELECT event_id, user_id, value FROM events WHERE user_id NOT IN (3, 5, 8, 13, 21)"
ORACLES["bbox_filter"] = """
    SELECT l_orderkey, l_linenumber, l_partkey, l_discount, l_tax FROM lineitem
    WHERE l_discount >= CAST(0.02 AS DOUBLE) AND l_discount <= CAST(0.05 AS DOUBLE) AND l_tax >= CAST(0.01 AS DOUBLE) AND l_tax <= CAST(0.04 AS DOUBLE)"""
ORACLES["bbox_by_cell"] = ORACLES["bbox_filter"]
ORACLES["membership_flag"] = "SELECT event_id, user_id IN (3, 5, 8, 13, 21) AS listed FROM events"

# Merge and incremental refresh ----------------------------------------------------------------
_merged = """
    SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderstatus,
        CASE WHEN o_orderdate >= TIMESTAMP '1999-01-01' AND o_orderstatus = 'O' THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
        o_orderdate,
        CASE WHEN o_orderdate < TIMESTAMP '2000-01-01' THEN TIMESTAMP '2000-01-01' ELSE TIMESTAMP '2002-01-01' END AS ingested_at,
        CASE WHEN o_orderdate >= TIMESTAMP '2000-01-01' OR (o_orderdate >= TIMESTAMP '1999-01-01' AND o_orderstatus = 'O')
             THEN TIMESTAMP '2002-01-01' ELSE TIMESTAMP '2000-01-01' END AS updated_at,
        CASE WHEN o_orderdate >= TIMESTAMP '1999-01-01' THEN TIMESTAMP '2002-01-01' ELSE TIMESTAMP '2000-01-01' END AS refreshed_at"""
ORACLES["merge_changes"] = f"""{_merged},
        CASE WHEN o_orderdate < TIMESTAMP '1999-01-01' THEN 'keep' WHEN o_orderdate >= TIMESTAMP '2000-01-01' THEN 'insert'
             WHEN o_orderstatus = 'O' THEN 'update' ELSE 'refresh' END AS _action FROM orders"""
ORACLES["upsert_table"] = f"{_merged} FROM orders"
ORACLES["upsert_bucketed"] = ORACLES["stream_upsert"] = ORACLES["upsert_files"] = ORACLES["upsert_table"]
_late = """WITH late AS (SELECT o_orderkey, o_totalprice, o_orderdate, o_orderdate + to_days(CAST(o_orderkey % 40 AS INTEGER)) AS updated_at FROM orders),
    loaded AS (SELECT * FROM late WHERE updated_at <= TIMESTAMP '2001-07-20'),
    mark AS (SELECT coalesce(max(updated_at), TIMESTAMP '1900-01-01') AS watermark FROM loaded
             WHERE o_orderdate >= TIMESTAMP '2001-07-25' - INTERVAL 15 DAY),
    days AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM late
             WHERE o_orderdate >= TIMESTAMP '2001-07-25' - INTERVAL 15 DAY AND updated_at >= (SELECT watermark FROM mark))"""
ORACLES["refresh_watermark"] = f"{_late} SELECT watermark FROM mark"
ORACLES["changed_days"] = f"{_late} SELECT day FROM days"
ORACLES["rows_of_changed_days"] = f"{_late} SELECT * FROM late WHERE CAST(o_orderdate AS DATE) IN (SELECT day FROM days)"
ORACLES["incremental_overwrite"] = f"""{_late}, months AS (SELECT DISTINCT date_trunc('month', day) AS m FROM days)
    SELECT *, CAST(1 AS INTEGER) AS row_count FROM late WHERE date_trunc('month', o_orderdate) IN (SELECT m FROM months)
    UNION ALL SELECT *, CAST(1 AS INTEGER) FROM loaded WHERE date_trunc('month', o_orderdate) NOT IN (SELECT m FROM months)"""
ORACLES["refresh_after_kill"] = ORACLES["incremental_overwrite"]

# months with a shipment updated since the newest loaded one are taken from all rows, others from the loaded ones
_stage_rule = """QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_shipdate
        ORDER BY l_linenumber DESC, l_quantity, CAST(l_partkey AS VARCHAR), l_returnflag, l_linestatus) = 1"""
ORACLES["refresh_measurements"] = f"""WITH {_sensors}, {_places}, versions AS (SELECT *, l_shipdate + to_hours(l_linenumber) AS u FROM lineitem),
    early AS (SELECT * FROM versions WHERE u <= TIMESTAMP '2001-10-20'),
    changed AS (SELECT DISTINCT date_trunc('month', l_shipdate) AS m FROM versions
        WHERE l_shipdate >= TIMESTAMP '2001-10-30' - INTERVAL 15 DAY
          AND u >= (SELECT max(u) FROM early WHERE l_shipdate >= TIMESTAMP '2001-10-30' - INTERVAL 15 DAY)),
    kept AS (
        SELECT * FROM versions WHERE date_trunc('month', l_shipdate) IN (SELECT m FROM changed) {_stage_rule}
        UNION ALL SELECT * FROM early WHERE date_trunc('month', l_shipdate) NOT IN (SELECT m FROM changed) {_stage_rule})
    SELECT s.location_id, CAST(l_orderkey AS VARCHAR) AS sensor_id, l_quantity AS value, s.sensor_name, CAST(l_partkey AS VARCHAR) AS parameter_id,
        l_returnflag AS parameter_name, l_linestatus AS parameter_units, s.parameter_displayname, l_shipdate AS datetimeto_utc, l_shipdate AS datetimeto_local,
        l.timezone, l.location_name, l.coordinates_latitude AS location_latitude, l.coordinates_longitude AS location_longitude, l.ismobile, l.ismonitor,
        l.datetimefirst_utc, l.datetimelast_utc, l.country_name, l.owner_name, l.provider_name, l_shipdate AS ingested_at, u AS updated_at, u AS refreshed_at
    FROM kept LEFT JOIN sensors s ON CAST(l_orderkey AS VARCHAR) = s.id LEFT JOIN locations l ON s.location_id = l.id"""
_renamed = "provider_name = 'BUILDING'"
ORACLES["ingest_upsert_locations"] = f"""SELECT * REPLACE (
        CASE WHEN {_renamed} THEN name || '*' ELSE name END AS name, TIMESTAMP '2024-02-02' AS refreshed_at,
        CASE WHEN {_renamed} THEN TIMESTAMP '2024-02-02' ELSE updated_at END AS updated_at) FROM ({ORACLES["ingest_locations"]}) x"""
_batch = "TIMESTAMP '2024-02-01' AS ingested_at, TIMESTAMP '2024-02-01' AS updated_at, TIMESTAMP '2024-02-01' AS refreshed_at"
ORACLES["ingest_sensors"] = f"""
    SELECT CAST(o_orderkey AS VARCHAR) AS id, CAST(o_custkey AS VARCHAR) AS location_id, o_orderpriority AS name, CAST(o_custkey AS VARCHAR) AS parameter_id,
        o_orderstatus AS parameter_name, CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS parameter_units, CAST(NULL AS VARCHAR) AS "parameter_displayName",
        {_batch} FROM orders"""
ORACLES["ingest_measurements"] = f"""
    SELECT CAST(l_orderkey AS VARCHAR) AS sensor_id, CASE WHEN l_linestatus <> 'F' THEN l_quantity END AS value, l_returnflag = 'R' AS "flagInfo_hasFlags",
        CAST(l_partkey AS VARCHAR) AS parameter_id, l_returnflag AS parameter_name, CAST(NULL AS VARCHAR) AS parameter_units,
        CAST(NULL AS VARCHAR) AS "parameter_displayName", 'raw' AS period_label, '01:00:00' AS period_interval,
        l_shipdate - INTERVAL 1 HOUR AS "period_datetimeFrom_utc", l_shipdate - INTERVAL 1 HOUR AS "period_datetimeFrom_local",
        l_shipdate AS "period_datetimeTo_utc", l_shipdate AS "period_datetimeTo_local", l_discount AS summary_min,
        {", ".join(f"CAST(NULL AS DOUBLE) AS summary_{q}" for q in ("q02", "q25", "median", "q75", "q98", "max"))}, l_tax AS summary_avg,
        CAST(NULL AS DOUBLE) AS summary_sd, l_suppkey AS "coverage_expectedCount", CAST(NULL AS VARCHAR) AS "coverage_expectedInterval",
        CAST(l_linenumber AS BIGINT) AS "coverage_observedCount", CAST(NULL AS VARCHAR) AS "coverage_observedInterval",
        CAST(100 AS DOUBLE) AS "coverage_percentComplete", CAST(NULL AS DOUBLE) AS "coverage_percentCoverage",
        l_shipdate - INTERVAL 1 HOUR AS "coverage_datetimeFrom_utc", l_shipdate - INTERVAL 1 HOUR AS "coverage_datetimeFrom_local",
        CAST(NULL AS TIMESTAMP) AS "coverage_datetimeTo_utc", CAST(NULL AS TIMESTAMP) AS "coverage_datetimeTo_local", {_batch}
    FROM lineitem"""
ORACLES["json_documents"] = ORACLES["ingest_locations"]

# Normalisation and flattening -----------------------------------------------------------------
ORACLES["sanitize_cast"] = """
    SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CASE WHEN o_orderstatus = 'F' THEN o_totalprice END AS ratio,
        CASE WHEN o_orderstatus <> 'O' THEN o_custkey WHEN o_totalprice = floor(o_totalprice) THEN CAST(o_totalprice AS BIGINT) END AS price,
        CASE WHEN o_orderstatus <> 'F' THEN o_orderstatus END AS status, o_orderdate - INTERVAL 9 HOUR AS day_utc, o_orderdate AS day_local,
        CAST(NULL AS DOUBLE) AS absent, TIMESTAMP '2024-02-01' AS ingested_at, TIMESTAMP '2024-02-01' AS updated_at, TIMESTAMP '2024-02-01' AS refreshed_at
    FROM orders"""
ORACLES["local_to_utc"] = "SELECT event_id, ts - INTERVAL 9 HOUR AS ts_utc FROM events"
# fixed values: midnights the clocks of Sao Paulo skipped, from the public time zone database
ORACLES["ambiguous_local_times"] = """
    SELECT o_orderkey, o_orderdate FROM orders WHERE CAST(o_orderdate AS DATE) IN (DATE '1995-10-15', DATE '1996-10-06', DATE '1997-10-06',
        DATE '1998-10-11', DATE '1999-10-03', DATE '2000-10-08')"""
# fixed values: midnights at which they went back to 23:00
ORACLES["doubled_local_times"] = """
    SELECT o_orderkey, o_orderdate - INTERVAL 30 MINUTE AS local FROM orders WHERE CAST(o_orderdate AS DATE) IN (DATE '1995-02-19', DATE '1996-02-11',
        DATE '1997-02-16', DATE '1998-03-01', DATE '1999-02-21', DATE '2000-02-27', DATE '2001-02-18')"""
ORACLES["parse_datetime_columns"] = """
    SELECT o_orderkey, o_orderdate AS datetime_local, o_orderdate - INTERVAL 9 HOUR AS datetime_utc FROM orders"""
ORACLES["flatten_json"] = """
    SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS body_props_k, event_type AS body_what_event_type, value AS body_what_value FROM events"""
ORACLES["explode_children"] = """
    SELECT doc_id AS location_id, CAST(i - 1 AS INTEGER) AS id, parts[i] AS name, CAST(length(parts[i]) AS INTEGER) AS parameter_units, lang AS "parameter_displayName"
    FROM (SELECT *, unnest(generate_series(1, len(parts))) AS i FROM (SELECT doc_id, lang, string_split(text, chr(10)) AS parts FROM documents) s) e"""
ORACLES["array_to_columns"] = """
    SELECT c_custkey AS id, c_acctbal AS bounds_min_lon, c_acctbal + 1 AS bounds_min_lat, c_acctbal + 2 AS bounds_max_lon,
        c_acctbal + 3 AS bounds_max_lat FROM customer"""
ORACLES["canonical_order"] = """
    SELECT event_id, ts, user_id, CAST(ts AS DATE) AS day,
        CAST(row_number() OVER (PARTITION BY CAST(ts AS DATE) ORDER BY ts, user_id, event_id) AS INTEGER) AS position FROM events"""
ORACLES["scalar_functions"] = """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate,
        CAST(date_trunc('day', l_shipdate) AS TIMESTAMP) AS ship_day, CAST(date_trunc('month', l_shipdate) AS TIMESTAMP) AS ship_month,
        strftime(l_shipdate, '%Y-%m') AS month_label, l_shipdate - INTERVAL 15 DAY AS lookback_start,
        date_diff('hour', l_shipdate, TIMESTAMP '2002-01-01 00:30:00') AS hours_until,
        CAST(l_orderkey AS VARCHAR) || '_S' || CAST(l_linenumber AS VARCHAR) AS label,
        CASE WHEN l_linenumber <> 1 THEN l_quantity / (l_linenumber - 1) END AS safe_ratio,
        greatest(coalesce(l_quantity, 0), CAST(l_linenumber AS DOUBLE)) AS larger, l_returnflag IS DISTINCT FROM 'A' AS differs,
        pow(l_quantity, 2) AS squared, CASE WHEN l_linestatus <> 'F' THEN l_linestatus END AS status,
        CASE WHEN NOT (l_tax > CAST(0.04 AS DOUBLE)) THEN CAST(l_linenumber AS DOUBLE) END AS as_double,
        CASE WHEN NOT (l_tax > CAST(0.04 AS DOUBLE)) THEN CAST(l_linenumber AS BIGINT) END AS as_long
    FROM lineitem"""

# Sources and sinks ----------------------------------------------------------------------------
ORACLES["typed_scan"] = "SELECT s_suppkey, s_name, s_acctbal, CAST(NULL AS VARCHAR) AS not_there FROM supplier"
ORACLES["skip_unreadable"] = "SELECT s_suppkey, s_name, s_acctbal FROM supplier"
ORACLES["quarantine_rows"] = "SELECT CAST(s_suppkey AS BIGINT) AS s_suppkey, s_name, s_acctbal FROM supplier"
ORACLES["quarantine_files"] = "SELECT * FROM (VALUES ('cut', 'ArrowInvalid', 2::BIGINT), ('text', 'ArrowInvalid', 1::BIGINT)) t(place, kind, n_files)"
ORACLES["concat_widened"] = """
    SELECT o_orderkey, CAST(CASE o_orderkey % 4 WHEN 0 THEN 0 WHEN 1 THEN o_totalprice WHEN 2 THEN o_custkey ELSE 3 END AS DOUBLE) AS amount,
        CASE o_orderkey % 4 WHEN 0 THEN CAST(o_custkey AS VARCHAR) WHEN 1 THEN o_orderstatus END AS code,
        CASE o_orderkey % 4 WHEN 0 THEN date_trunc('day', o_orderdate)::TIMESTAMP WHEN 1 THEN o_orderdate END AS at,
        CASE o_orderkey % 4 WHEN 0 THEN CAST(o_custkey AS VARCHAR) WHEN 3 THEN '{"c":' || o_custkey || '}' END AS odd
    FROM orders"""
ORACLES["concat_conflicts"] = "SELECT * FROM (VALUES ('0', 'odd', 'bigint', 'string'), ('3', 'odd', 'nested', 'string')) t(folder, name, type, read_as)"
ORACLES["typed_sink"] = """
    SELECT CAST(l_orderkey AS VARCHAR) AS sensor_id, l_quantity AS value, CAST(NULL AS BOOLEAN) AS "flagInfo_hasFlags", CAST(l_partkey AS VARCHAR) AS parameter_id,
        l_returnflag AS parameter_name, l_linestatus AS parameter_units, CAST(NULL AS VARCHAR) AS "parameter_displayName", CAST(NULL AS VARCHAR) AS period_label,
        CAST(NULL AS VARCHAR) AS period_interval, l_shipdate - INTERVAL 1 HOUR AS "period_datetimeFrom_utc", l_shipdate - INTERVAL 1 HOUR AS "period_datetimeFrom_local",
        l_shipdate AS "period_datetimeTo_utc", l_shipdate AS "period_datetimeTo_local", """ + ", ".join(
    f"CAST(NULL AS DOUBLE) AS summary_{q}" for q in ("min", "q02", "q25", "median", "q75", "q98", "max", "avg", "sd")
) + """, l_suppkey AS "coverage_expectedCount", CAST(NULL AS VARCHAR) AS "coverage_expectedInterval", CAST(l_linenumber AS BIGINT) AS "coverage_observedCount",
        CAST(NULL AS VARCHAR) AS "coverage_observedInterval", CAST(NULL AS DOUBLE) AS "coverage_percentComplete", CAST(NULL AS DOUBLE) AS "coverage_percentCoverage",
        CAST(NULL AS TIMESTAMP) AS "coverage_datetimeFrom_utc", CAST(NULL AS TIMESTAMP) AS "coverage_datetimeFrom_local",
        CAST(NULL AS TIMESTAMP) AS "coverage_datetimeTo_utc", CAST(NULL AS TIMESTAMP) AS "coverage_datetimeTo_local", l_shipdate AS ingested_at,
        l_shipdate + to_hours(l_linenumber) AS updated_at, l_shipdate + to_hours(l_linenumber) AS refreshed_at FROM lineitem"""
ORACLES["concat_union"] = """
    SELECT c_custkey AS key, c_name AS name, c_acctbal AS balance, c_mktsegment AS market FROM customer
    UNION ALL SELECT s_suppkey, s_name, s_acctbal, NULL FROM supplier"""
ORACLES["csv_concat"] = "SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders"
ORACLES["load_append"] = "SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, 2 * count(*) AS copies FROM orders GROUP BY 1"
ORACLES["export_query"] = "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'"
ORACLES["param_query"] = """
    SELECT o_orderstatus, count(*) AS n_orders, max(o_totalprice) AS max_price FROM orders
    WHERE o_orderstatus IN ('O', 'P') AND o_totalprice >= 1000 GROUP BY 1"""
_attempts = """WITH attempts AS (
    SELECT CAST(doc_id AS VARCHAR) AS run_id, lang, n_chars, i, len(parts) AS n,
        list_filter(string_split(parts[i], ' '), lambda w: length(w) > 0 AND regexp_matches(w, '[0-9]')) AS bad,
        list_filter(string_split(parts[i], ' '), lambda w: length(w) > 0 AND NOT regexp_matches(w, '[0-9]')) AS good
    FROM (SELECT *, unnest(generate_series(1, len(parts))) AS i FROM (SELECT doc_id, lang, n_chars, string_split(text, chr(10)) AS parts FROM documents) s) e)"""
ORACLES["run_log_summary"] = f"""{_attempts}
    SELECT run_id, CAST(1 AS BIGINT) AS sensor_count, count(*) AS attempts, CAST(sum(len(bad)) AS BIGINT) AS errors, CAST(sum(len(good)) AS BIGINT) AS saved,
        count(CASE WHEN len(bad) BETWEEN 1 AND 5 THEN 1 END) AS retries,
        CASE WHEN max(CASE WHEN i = n THEN len(bad) END) > 5 THEN 'aborted' ELSE 'downloaded' END AS status, n_chars / 4 AS download_duration,
        CASE WHEN lang <> 'en' THEN CAST(0.5 AS DOUBLE) END AS saving_duration,
        CAST(CASE lang WHEN 'de' THEN n_chars + 0.25 WHEN 'en' THEN NULL ELSE n_chars / 4 + 0.5 END AS DOUBLE) AS total_duration
    FROM attempts GROUP BY run_id, lang, n_chars"""
ORACLES["run_log_files"] = ORACLES["run_log_summary"]
_sums = [f"CAST(sum({c}) AS BIGINT) AS {c}" for c in ("attempts", "errors", "saved", "retries")]
_sums += [f"coalesce(sum({c}), 0) AS {c}" for c in ("download_duration", "saving_duration", "total_duration")]
ORACLES["run_log_totals"] = f"""SELECT count(*) AS runs, count(CASE WHEN status = 'aborted' THEN 1 END) AS aborted_runs, {", ".join(_sums)}
    FROM ({ORACLES["run_log_summary"]}) x"""
ORACLES["run_log_error_rows"] = f"""{_attempts}
    SELECT run_id, i AS attempt, CASE WHEN len(bad) > 5 THEN 'aborted' ELSE 'retrying' END AS attempt_status, unnest(bad) AS sensor_id, lang AS type
    FROM attempts"""

# Checks ---------------------------------------------------------------------------------------
ORACLES["check_unique"] = "SELECT l_orderkey, count(*) AS n_rows FROM lineitem GROUP BY 1 HAVING count(*) > 1"
ORACLES["check_unique_combination"] = "SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1"
ORACLES["check_unique_recent"] = """
    SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem WHERE l_shipdate >= TIMESTAMP '2001-01-01' GROUP BY 1, 2 HAVING count(*) > 1"""
ORACLES["check_not_null"] = """
    SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name, CAST(NULL AS DOUBLE) AS distance, CAST(c_nationkey AS VARCHAR) AS provider_id
    FROM customer WHERE c_nationkey % 2 = 1"""
ORACLES["check_relationship"] = """
    SELECT user_id, count(*) AS n_rows FROM events WHERE user_id NOT IN (SELECT s_suppkey FROM supplier) GROUP BY 1"""
ORACLES["check_freshness"] = """
    SELECT m AS max_loaded_at, round(h, 6) AS age_hours, CASE WHEN h > 72 THEN 'error' WHEN h > 24 THEN 'warn' ELSE 'pass' END AS status
    FROM (SELECT max(ts) AS m, (epoch_us(TIMESTAMP '2024-02-01 12:00:00') - epoch_us(max(ts))) / 3.6e9 AS h FROM events) f"""
ORACLES["check_at_least_one"] = """
    SELECT * FROM (SELECT 'value' AS column_name, count(value) AS n_values FROM events
                   UNION ALL SELECT 'bonus', count(CASE WHEN value < 0 THEN value END) FROM events) c WHERE n_values = 0"""
ORACLES["check_accepted_values"] = """
    SELECT o_orderpriority, count(*) AS n_rows FROM orders WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH') GROUP BY 1"""
ORACLES["check_declared_constraints"] = """
    SELECT 'locations' AS table_name, 'unique(id)' AS rule,
           (SELECT count(*) FROM (SELECT c_custkey FROM customer GROUP BY 1 HAVING count(*) > 1) q) AS violations
    UNION ALL SELECT 'locations', 'required', (SELECT count(*) FROM customer WHERE c_custkey IS NULL)
    UNION ALL SELECT 'sensors', 'unique(id)', (SELECT count(*) FROM (SELECT o_orderkey FROM orders GROUP BY 1 HAVING count(*) > 1) q)
    UNION ALL SELECT 'sensors', 'required', (SELECT count(*) FROM orders WHERE o_orderkey IS NULL OR o_custkey IS NULL OR o_orderdate IS NULL)
    UNION ALL SELECT 'sensors', 'location_id -> locations.id', (SELECT count(*) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer))
    UNION ALL SELECT 'measurements', 'unique(sensor_id, period_datetimeTo_utc)',
           (SELECT count(*) FROM (SELECT l_orderkey, l_shipdate FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1) q)
    UNION ALL SELECT 'measurements', 'required', (SELECT count(*) FROM lineitem WHERE l_orderkey IS NULL OR l_shipdate IS NULL OR l_linenumber IS NULL)
    UNION ALL SELECT 'measurements', 'sensor_id -> sensors.id', (SELECT count(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders))"""
ORACLES["row_reconciliation"] = "SELECT count(*) AS rows_in_files, count(*) AS rows_in_frame FROM orders"
