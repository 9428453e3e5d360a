"""DuckDB statements that state the result of every registered query
independently of Spark (row numbering by window, wide tables by one filtered
aggregate per column, the incremental runs as chained CTEs).  Column names
equal the Spark results'.

Views ``region nation customer supplier part orders lineitem events ...`` are
registered by the caller.  Every statement can itself be stored as a view: the
columns of a wide table are written out, none depends on the data.
"""

from __future__ import annotations

import datetime as dt

from . import registry as R
from .sources.testdata import LESS50_SLOTS, SLOTS


def _nf(cols: str) -> str:
    return ", ".join(f"{c.strip()} NULLS FIRST" for c in cols.split(","))


def rnd(x: str) -> str:
    """Half up on the shortest decimal text of a double."""
    return f"CAST(round(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,17)), 2) AS DOUBLE)"


def value_name_sql(x: str) -> str:
    parts = f"string_split({x}, '_')"
    last = f"{parts}[-1]"
    return (f"lower(regexp_replace(CASE "
            f"WHEN strpos(lower({x}), 'ahur') > 0 THEN substr({x}, strpos(lower({x}), 'ahur')) "
            f"WHEN {last} = '' THEN {x} "
            f"WHEN regexp_matches(substr({last}, 1, 1), '^[0-9]$') THEN "
            f"CASE WHEN len({parts}) >= 2 THEN {parts}[-2] || '_' || {last} ELSE {last} END "
            f"ELSE {last} END, '[^a-zA-Z0-9_]', '_', 'g'))")


EV_ORDER = _nf("ts, event_id")
S5 = (f"(SELECT event_type AS point, row_number() OVER (PARTITION BY event_type ORDER BY "
      f"{EV_ORDER}) AS unique_id, ts, value FROM events)")
EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]
SLOT_POINTS = [f"{e}_{k}" for e in EVENT_TYPES for k in range(SLOTS)]
SS = (f"(SELECT event_type || '_' || (event_id % {SLOTS}) AS point, row_number() OVER (PARTITION BY "
      f"event_type, event_id % {SLOTS} ORDER BY {EV_ORDER}) AS unique_id, ts, value FROM events)")
SM = (f"(SELECT CAST(user_id AS VARCHAR) AS point, row_number() OVER (PARTITION BY user_id "
      f"ORDER BY {EV_ORDER}) AS unique_id, ts, value FROM events)")
LI_TB = "l_orderkey, l_linenumber, l_partkey, l_quantity, l_discount, l_tax, " \
        "l_returnflag, l_linestatus"
LI_ORDER = _nf(f"l_shipdate, {LI_TB}, l_extendedprice")


def _ts(d) -> str:
    if not isinstance(d, dt.datetime):
        d = dt.datetime.combine(d, dt.time.min)
    return f"TIMESTAMP '{d.isoformat(sep=' ')}'"


def spread(source: str, points: list[str], key: str = "point", value: str | None = "value",
           ts: str | None = None) -> str:
    """One row per id with a column per point: its value and, if asked, its time."""
    cols = [f"max({value}) FILTER (WHERE {key} = '{p}') AS \"{p}\"" for p in points if value]
    cols += [f"max({ts}) FILTER (WHERE {key} = '{p}') AS \"timestamp_{p}\"" for p in points if ts]
    return f"(SELECT unique_id, {', '.join(cols)} FROM {source} GROUP BY unique_id)"


# --- wide tables over the five-point staging ----------------------------------------
def aligned5(value: str) -> str:
    return f"""(WITH s AS {S5},
ids AS (SELECT unique_id FROM s GROUP BY unique_id
        HAVING count(*) = (SELECT count(DISTINCT point) FROM s)),
base AS (SELECT unique_id, ts AS "timestamp" FROM s WHERE point = (SELECT min(point) FROM s)),
pv AS {spread(S5, EVENT_TYPES, value=value)}
SELECT pv.*, base."timestamp" FROM pv JOIN ids USING (unique_id) JOIN base USING (unique_id))"""


ALIGNED5 = aligned5("value")
RAGGED5 = spread(S5, EVENT_TYPES, ts="ts")

# ragged rows with the base point's time as ``bts`` (the resolved time column)
RAGGED5_BTS = f"""(SELECT r.*, b.ts AS bts FROM {RAGGED5} r LEFT JOIN
  (SELECT unique_id, ts FROM {S5} WHERE point = (SELECT min(event_type) FROM events)) b
  USING (unique_id))"""

RAGGED5_IDS = f"""(SELECT i.unique_id, b.ts AS bts FROM (SELECT DISTINCT unique_id FROM {S5}) i
  LEFT JOIN (SELECT unique_id, ts FROM {S5} WHERE point = (SELECT min(event_type) FROM events)) b
  USING (unique_id))"""

COMPLETE5 = f"""(SELECT unique_id FROM {S5} GROUP BY unique_id
  HAVING count(*) = (SELECT count(DISTINCT event_type) FROM events))"""


# --- incremental runs over events -------------------------------------------------------
def events_runs(buffer_sql: str, days: int = 30) -> str:
    lb1 = _ts(R.FIRST_AS_OF - dt.timedelta(days=days))
    lb2 = _ts(R.SECOND_AS_OF - dt.timedelta(days=days))
    end1 = _ts(R.FIRST_AS_OF + dt.timedelta(days=1))
    end2 = _ts(R.SECOND_AS_OF + dt.timedelta(days=1))
    return f"""pts AS (SELECT DISTINCT event_type AS point FROM events),
r1 AS (SELECT event_type AS point, row_number() OVER (PARTITION BY event_type ORDER BY {EV_ORDER})
         AS unique_id, ts, {rnd('value')} AS value FROM events
       WHERE ts > {lb1} AND ts < {end1}),
hw AS (SELECT pts.point, max(r1.ts) AS hwm, max(r1.unique_id) AS last_id, count(r1.ts) AS n1
       FROM pts LEFT JOIN r1 USING (point) GROUP BY pts.point),
r2 AS (SELECT e.event_type AS point, coalesce(hw.last_id, 0) + row_number() OVER
         (PARTITION BY e.event_type ORDER BY {_nf('e.ts, e.event_id')}) AS unique_id,
         e.ts, {rnd('e.value')} AS value
       FROM events e JOIN hw ON e.event_type = hw.point
       WHERE e.ts > coalesce(hw.hwm + {buffer_sql}, {lb2}) AND e.ts < {end2}),
staged AS (SELECT point, unique_id, ts, value FROM r1
           UNION ALL SELECT point, unique_id, ts, value FROM r2)"""


def lineitem_runs(first_filter: str, second_filter: str) -> str:
    lb1 = _ts(R.LI_FIRST_AS_OF - dt.timedelta(days=R.LI_WINDOW_DAYS))
    lb2 = _ts(R.LI_SECOND_AS_OF - dt.timedelta(days=R.LI_WINDOW_DAYS))
    end1 = _ts(R.LI_FIRST_AS_OF + dt.timedelta(days=1))
    end2 = _ts(R.LI_SECOND_AS_OF + dt.timedelta(days=1))
    return f"""sn AS (SELECT CAST(s_suppkey AS VARCHAR) AS point, n_name FROM supplier
       JOIN nation ON s_nationkey = n_nationkey),
pa AS (SELECT DISTINCT point FROM sn WHERE {first_filter}),
pb AS (SELECT DISTINCT point FROM sn WHERE {second_filter}),
li AS (SELECT CAST(l_suppkey AS VARCHAR) AS point, l_shipdate AS ts, l_extendedprice AS value,
       {LI_TB} FROM lineitem),
r1 AS (SELECT li.point, row_number() OVER (PARTITION BY li.point ORDER BY
         {_nf('ts, ' + LI_TB + ', value')}) AS unique_id, ts, {rnd('value')} AS value
       FROM li JOIN pa USING (point) WHERE ts > {lb1} AND ts < {end1}),
s1 AS (SELECT pa.point, max(r1.ts) AS hwm, count(r1.ts) AS last_used_id
       FROM pa LEFT JOIN r1 USING (point) GROUP BY pa.point),
r2 AS (SELECT li.point, coalesce(s1.last_used_id, 0) + row_number() OVER
         (PARTITION BY li.point ORDER BY {_nf('li.ts, ' + ', '.join('li.' + c.strip() for c in LI_TB.split(',')) + ', li.value')})
         AS unique_id, li.ts, {rnd('li.value')} AS value
       FROM li JOIN pb USING (point) LEFT JOIN s1 USING (point)
       WHERE li.ts > coalesce(s1.hwm + INTERVAL 10 SECOND, {lb2}) AND li.ts < {end2}),
s2 AS (SELECT pb.point, coalesce(s1.last_used_id, 0) + count(r2.ts) AS last_used_id
       FROM pb LEFT JOIN s1 USING (point) LEFT JOIN r2 USING (point)
       GROUP BY pb.point, s1.last_used_id)"""


def stream_sql() -> str:
    lb = _ts(R.STREAM_AS_OF - dt.timedelta(days=30))
    end = _ts(R.STREAM_AS_OF + dt.timedelta(days=1))
    a, b = (_ts(dt.date.fromisoformat(x)) for x in R.STREAM_SLICES)
    order = _nf("e.ts, e.event_id")
    buf = f"INTERVAL {R.AUDIT_BUFFER_SECONDS} SECOND"

    def batch(k, prev):
        base = "0" if prev is None else f"{prev}.n"
        start = lb if prev is None else f"coalesce({prev}.hwm + {buf}, {lb})"
        join = "" if prev is None else f"JOIN {prev} USING (point)"
        return (f"SELECT e.point, {base} + row_number() OVER (PARTITION BY e.point ORDER BY "
                f"{order}) AS unique_id, e.ts, {rnd('e.value')} AS value FROM e {join} "
                f"WHERE e.slice = {k} AND e.ts > {start} AND e.ts < {end}")

    return f"""WITH e AS (SELECT event_type AS point, ts, event_id, value,
    CASE WHEN ts < {a} THEN 1 WHEN ts < {b} THEN 2 ELSE 3 END AS slice FROM events),
pts AS (SELECT DISTINCT point FROM e),
b1 AS ({batch(1, None)}),
h1 AS (SELECT pts.point, max(b1.ts) AS hwm, count(b1.ts) AS n FROM pts LEFT JOIN b1 USING (point)
       GROUP BY pts.point),
b2 AS ({batch(2, 'h1')}),
h2 AS (SELECT h1.point, coalesce(max(b2.ts), h1.hwm) AS hwm, h1.n + count(b2.ts) AS n
       FROM h1 LEFT JOIN b2 USING (point) GROUP BY h1.point, h1.hwm, h1.n),
b3 AS ({batch(3, 'h2')})
SELECT * FROM b1 UNION ALL SELECT * FROM b2 UNION ALL SELECT * FROM b3"""


def _sql() -> dict[str, str]:
    page_lo, page_hi = R.PAGE_START, R.PAGE_END
    cut = _ts(R.PURGE_AS_OF - dt.timedelta(days=30))
    run1 = _ts(dt.datetime.combine(R.LI_FIRST_AS_OF, dt.time(R.RUN_HOUR)))
    run2 = _ts(dt.datetime.combine(R.LI_SECOND_AS_OF, dt.time(R.RUN_HOUR)))
    nations_a = ", ".join(f"'{n}'" for n in R.FIRST_BIOMES)
    nations_b = ", ".join(f"'{n}'" for n in R.SECOND_BIOMES)
    all_sup = "TRUE"
    audit_lb = _ts(R.FIRST_AS_OF - dt.timedelta(days=30))
    audit_hi = _ts(R.SECOND_AS_OF + dt.timedelta(days=1))
    since = _ts(R.FRESH_AS_OF - dt.timedelta(hours=24))

    name_variants = f"""
SELECT 'part_full' AS kind, p_partkey AS id,
       concat_ws('_', p_brand, p_name, p_type, CAST(p_size AS VARCHAR)) AS raw_name FROM part
UNION ALL SELECT 'part_name', p_partkey, p_name FROM part
UNION ALL SELECT 'part_marker', p_partkey,
       concat_ws('_', p_type, 'AHUR' || CAST(p_size AS VARCHAR), p_name) FROM part
UNION ALL SELECT 'part_trailing', p_partkey, p_brand || '_' FROM part
UNION ALL SELECT 'supplier', s_suppkey, s_name FROM supplier"""

    coll_point = ("lower(upper(event_type) || CASE WHEN length(event_type) <= 5 "
                  "THEN '_TEMP' ELSE '_RH_1' END)")
    coll_s = (f"(SELECT {coll_point} AS point, row_number() OVER (PARTITION BY event_type "
              f"ORDER BY {EV_ORDER}) AS unique_id, ts, value FROM events)")
    coll_named = (f"(SELECT s.*, CASE WHEN nm.k > 1 THEN nm.name || '__' || s.point ELSE nm.name END AS colname "
                  f"FROM {coll_s} s JOIN (SELECT point, name, count(*) OVER (PARTITION BY name) "
                  f"AS k FROM (SELECT DISTINCT point, {value_name_sql('point')} AS name "
                  f"FROM {coll_s})) nm USING (point))")

    # value names: click_temp, error_temp, view_temp -> temp; purchase_rh_1, signup_rh_1 -> rh_1
    coll_columns = [f"temp__{e}_temp" for e in EVENT_TYPES if len(e) <= 5]
    coll_columns += [f"rh_1__{e}_rh_1" for e in EVENT_TYPES if len(e) > 5]
    slot_points = (f"SELECT DISTINCT event_type || '_' || (event_id % {SLOTS}) AS point FROM events "
                   f"WHERE event_id % {SLOTS}")
    lp, bp = f"({slot_points} < {LESS50_SLOTS})", f"({slot_points} >= {LESS50_SLOTS})"

    def bucket_row(cat, pts):
        return (f"SELECT '{cat}' AS category, 'wide_{cat}' AS table_name, "
                f"(SELECT count(DISTINCT unique_id) FROM {SS} WHERE point IN {pts}) AS row_count, "
                f"(SELECT count(*) FROM {pts}) > 0 AS available, "
                f"CAST(CASE WHEN (SELECT count(*) FROM {pts}) > 0 "
                f"THEN 1 + 2 * (SELECT count(*) FROM {pts}) ELSE 0 END AS INTEGER) AS column_count")

    inventory = f"""(SELECT point AS table_name, count(*) AS row_count FROM {SM} GROUP BY point
UNION ALL SELECT 'staging_metadata', count(DISTINCT user_id) FROM events
UNION ALL SELECT 'wide_less50', count(DISTINCT unique_id) FROM {SS} WHERE point IN {lp}
  HAVING count(*) > 0
UNION ALL SELECT 'wide_between50and100', count(DISTINCT unique_id) FROM {SS} WHERE point IN {bp}
  HAVING count(*) > 0)"""

    return {
        "page_aligned": f"""SELECT * FROM {ALIGNED5} a
WHERE CAST("timestamp" AS DATE) >= DATE '{page_lo}' AND CAST("timestamp" AS DATE) <= DATE '{page_hi}'
ORDER BY "timestamp" DESC NULLS LAST, unique_id ASC LIMIT {R.PAGE_LIMIT} OFFSET {R.PAGE_OFFSET}""",

        "assign_sequence": f"""SELECT CAST(l_suppkey AS VARCHAR) AS point,
  row_number() OVER (PARTITION BY l_suppkey ORDER BY {LI_ORDER}) AS unique_id,
  l_shipdate AS ts, l_extendedprice AS value, l_orderkey, l_linenumber FROM lineitem""",

        "round_reading": f"""SELECT l_orderkey, l_linenumber, l_suppkey,
  {rnd('l_extendedprice * l_discount')} AS reading FROM lineitem""",

        "value_column_name": f"""SELECT kind, id, raw_name, {value_name_sql('raw_name')} AS value_name
FROM ({name_variants})""",

        "manifest_restrict": f"""SELECT CAST(l_suppkey AS VARCHAR) AS point, l_shipdate AS ts,
  l_extendedprice AS value, l_orderkey, l_linenumber FROM lineitem
WHERE CAST(l_suppkey AS VARCHAR) IN (SELECT CAST(s_suppkey AS VARCHAR) FROM supplier
  JOIN nation ON s_nationkey = n_nationkey WHERE n_name = '{R.BIOME}')""",

        "extract_first_run": f"""SELECT event_type AS point, row_number() OVER
  (PARTITION BY event_type ORDER BY {EV_ORDER}) AS unique_id, ts, {rnd('value')} AS value
FROM events WHERE ts > {_ts(R.FIRST_AS_OF - dt.timedelta(days=30))}
  AND ts < {_ts(R.FIRST_AS_OF + dt.timedelta(days=1))}""",

        "extract_incremental": f"""WITH {events_runs('INTERVAL 10 SECOND')}
SELECT * FROM staged""",

        "late_rows_audit": f"""WITH {events_runs('INTERVAL 6 HOUR')},
src AS (SELECT event_type AS point, ts FROM events WHERE ts > {audit_lb} AND ts < {audit_hi})
SELECT point, count(*) AS late_rows, min(ts) AS first_late_ts, max(ts) AS last_late_ts
FROM src WHERE NOT EXISTS (SELECT 1 FROM staged s WHERE s.point = src.point AND s.ts = src.ts)
GROUP BY point""",

        "late_rows_purged": f"""WITH {events_runs('INTERVAL 6 HOUR', R.SHORT_WINDOW_DAYS)}
SELECT event_type AS point, count(*) AS late_rows, min(ts) AS first_late_ts, max(ts) AS last_late_ts
FROM events e WHERE ts >= {_ts(R.SECOND_AS_OF - dt.timedelta(days=R.SHORT_WINDOW_DAYS))} AND ts < {audit_hi}
  AND NOT EXISTS (SELECT 1 FROM staged s WHERE s.point = e.event_type AND s.ts = e.ts)
GROUP BY event_type""",

        "high_water_marks": f"""SELECT event_type AS point, max(ts) AS hwm,
  max(ts) + INTERVAL 10 SECOND AS next_start FROM events
WHERE ts > {_ts(R.FIRST_AS_OF - dt.timedelta(days=30))}
  AND ts < {_ts(R.FIRST_AS_OF + dt.timedelta(days=1))} GROUP BY event_type""",

        "last_ids": f"""WITH {events_runs('INTERVAL 10 SECOND')},
mx AS (SELECT point, max(unique_id) AS max_unique_id FROM staged GROUP BY point)
SELECT pts.point, mx.max_unique_id, hw.n1 AS state_last_used_id,
  coalesce(greatest(hw.n1, mx.max_unique_id), 0) AS last_used_id
FROM pts LEFT JOIN mx USING (point) LEFT JOIN hw USING (point)""",

        "staged_append": f"""WITH {lineitem_runs(all_sup, all_sup)}
SELECT point, unique_id, ts, value FROM r1 UNION ALL SELECT point, unique_id, ts, value FROM r2""",

        "metadata_upsert": f"""WITH {lineitem_runs(f'n_name IN ({nations_a})', f'n_name IN ({nations_b})')}
SELECT point, DATE '{R.LI_SECOND_AS_OF.isoformat()}' AS last_run_date,
  {run2} AS last_run_timestamp, last_used_id FROM s2
UNION ALL
SELECT point, DATE '{R.LI_FIRST_AS_OF.isoformat()}', {run1}, last_used_id FROM s1
WHERE point NOT IN (SELECT point FROM pb)""",

        "retention_kept": f"SELECT * FROM {S5} WHERE ts >= {cut}",

        "retention_purged_counts": f"""SELECT point, count(*) FILTER (WHERE ts < {cut}) AS purged_rows
FROM {S5} GROUP BY point""",

        "wide_aligned": f"SELECT * FROM {ALIGNED5}",

        "wide_ragged": f"SELECT * FROM {RAGGED5}",

        "wide_name_collisions": f"""WITH ids AS (SELECT unique_id FROM {coll_s} GROUP BY unique_id
   HAVING count(*) = (SELECT count(DISTINCT event_type) FROM events)),
base AS (SELECT unique_id, ts AS "timestamp" FROM {coll_s}
   WHERE point = (SELECT min({coll_point}) FROM events)),
pv AS {spread(coll_named, coll_columns, key="colname")}
SELECT pv.*, base."timestamp" FROM pv JOIN ids USING (unique_id) JOIN base USING (unique_id)""",

        "wide_many_points": spread(SS, SLOT_POINTS, ts="ts")[1:-1],

        "page_ragged": f"""SELECT * EXCLUDE (bts) FROM {RAGGED5_BTS} r
WHERE CAST(bts AS DATE) >= DATE '{R.RAGGED_PAGE_START}'
ORDER BY bts DESC NULLS LAST, unique_id ASC LIMIT 100""",

        "page_by_id": f"""SELECT * EXCLUDE (bts) FROM {RAGGED5_BTS} r WHERE unique_id = {R.PAGE_ID}
ORDER BY bts DESC NULLS LAST, unique_id ASC LIMIT 100""",

        "page_total": f"""SELECT {R.TOTAL_LIMIT} AS "limit", {R.TOTAL_OFFSET} AS "offset",
  count(*) AS total_count, ({R.TOTAL_LIMIT + R.TOTAL_OFFSET} < count(*)) AS has_more
FROM {ALIGNED5} a
WHERE CAST("timestamp" AS DATE) >= DATE '{page_lo}' AND CAST("timestamp" AS DATE) <= DATE '{page_hi}'""",

        "table_stats": f"""SELECT 'type1' AS category, count(*) AS total_records,
  min("timestamp") AS earliest_timestamp, max("timestamp") AS latest_timestamp,
  count(DISTINCT unique_id) AS unique_ids_count FROM {ALIGNED5} a
UNION ALL
SELECT 'other', count(*), min(bts), max(bts), count(DISTINCT unique_id) FROM {RAGGED5_IDS} r""",

        "column_stats": f"""SELECT 'type1' AS category, point AS "column", min(value) AS min_value,
  max(value) AS max_value, CAST(round(CAST(avg(value) AS DECIMAL(38,12)), 6) AS DOUBLE) AS avg_value,
  count(value) AS non_null_count
FROM {S5} s WHERE unique_id IN {COMPLETE5} GROUP BY point
UNION ALL
SELECT 'other', point, min(value), max(value),
  CAST(round(CAST(avg(value) AS DECIMAL(38,12)), 6) AS DOUBLE), count(value)
FROM {S5} s GROUP BY point""",

        "column_stats_many_points": f"""SELECT point AS "column", min(value) AS min_value,
  max(value) AS max_value, CAST(round(CAST(avg(value) AS DECIMAL(38,12)), 6) AS DOUBLE) AS avg_value,
  count(value) AS non_null_count
FROM {SS} m GROUP BY point""",

        "unique_ids": f"""SELECT DISTINCT unique_id FROM {S5} s ORDER BY unique_id LIMIT {R.ID_LIMIT}""",

        "time_range": f"""SELECT 'type1' AS category, min("timestamp") AS start_time,
  max("timestamp") AS end_time, count(*) AS total_records,
  count(DISTINCT CAST("timestamp" AS DATE)) AS unique_days FROM {ALIGNED5} a
UNION ALL
SELECT 'other', min(bts), max(bts), count(*), count(DISTINCT CAST(bts AS DATE)) FROM {RAGGED5_IDS} r""",

        "tables_overview": f"""SELECT 'type1' AS category, 'wide_type1' AS table_name,
  (SELECT count(*) FROM {ALIGNED5} a) AS row_count, TRUE AS available,
  CAST(2 + (SELECT count(DISTINCT event_type) FROM events) AS INTEGER) AS column_count
UNION ALL SELECT 'type2', 'wide_type2', 0, FALSE, 0
UNION ALL {bucket_row('less50', lp)}
UNION ALL {bucket_row('between50and100', bp)}
UNION ALL SELECT 'other', 'wide_other', (SELECT count(DISTINCT unique_id) FROM {S5} s), TRUE,
  CAST(1 + 2 * (SELECT count(DISTINCT event_type) FROM events) AS INTEGER)""",

        "run_status": """SELECT CAST(user_id AS VARCHAR) AS point, CAST(max(ts) AS DATE) AS last_run_date,
  max(ts) AS last_run_timestamp, count(*) AS last_used_id FROM events GROUP BY user_id""",

        "run_summary": """SELECT max(ts) AS latest_run, count(DISTINCT user_id) AS tables_processed
FROM events""",

        "table_inventory": f"""SELECT * FROM {inventory} i WHERE table_name NOT LIKE 'staging_%'""",

        "wide_inventory": f"""SELECT * FROM {inventory} i WHERE table_name LIKE 'wide_%'""",

        "table_counts": f"""SELECT count(*) FILTER (WHERE table_name NOT LIKE 'staging_%') AS source_tables,
  count(*) FILTER (WHERE table_name LIKE 'wide_%') AS wide_tables FROM {inventory} i""",

        "wide_missing_point": spread(S5, EVENT_TYPES, value=rnd("value"), ts="ts")[1:-1],

        "stored_wide_page": f"""SELECT * FROM {aligned5(rnd('value'))} a
WHERE CAST("timestamp" AS DATE) >= DATE '{page_lo}' AND CAST("timestamp" AS DATE) <= DATE '{page_hi}'
ORDER BY "timestamp" DESC NULLS LAST, unique_id ASC LIMIT {R.PAGE_LIMIT} OFFSET {R.PAGE_OFFSET}""",

        "stored_wide_total": f"""SELECT {R.TOTAL_LIMIT} AS "limit", {R.TOTAL_OFFSET} AS "offset",
  count(*) AS total_count, ({R.TOTAL_LIMIT + R.TOTAL_OFFSET} < count(*)) AS has_more
FROM {ALIGNED5} a
WHERE CAST("timestamp" AS DATE) >= DATE '{page_lo}' AND CAST("timestamp" AS DATE) <= DATE '{page_hi}'""",

        "data_freshness": f"""SELECT count(*) FILTER (WHERE m > {since}) AS fresh_tables,
  count(*) FILTER (WHERE m > {since}) > 0 AS is_fresh
FROM (SELECT user_id, max(ts) AS m FROM events GROUP BY user_id)""",

        "stream_extract": stream_sql(),
    }


ORACLE_SQL = _sql()
