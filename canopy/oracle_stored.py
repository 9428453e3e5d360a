"""DuckDB statements of the queries over stores (``canopy.registry_stored``)."""

from __future__ import annotations

import datetime as dt

from . import registry_stored as S
from .oracle import ALIGNED5, EVENT_TYPES, S5, _nf, _ts, rnd, spread
from .oracle import ORACLE_SQL as OTHER_SQL


def runs_sql(as_of: list[dt.date], days: int, skipped: dict[int, list[str]] | None = None,
             buffer: str = "INTERVAL 10 SECOND") -> str:
    """Chained CTEs of runs over ``events``: ``b<k>`` are the rows of run ``k``,
    ``h<k>`` the mark and counter of every point after it, ``staged`` all rows
    before any purge. ``skipped`` has the points that a run does not read."""
    out = ["pts AS (SELECT DISTINCT event_type AS point FROM events)",
           "h0 AS (SELECT point, CAST(NULL AS TIMESTAMP) AS hwm, CAST(0 AS BIGINT) AS n FROM pts)"]
    for k, day in enumerate(as_of, 1):
        lb, end = _ts(day - dt.timedelta(days=days)), _ts(day + dt.timedelta(days=1))
        without = "".join(f" AND e.event_type <> '{p}'" for p in (skipped or {}).get(k, []))
        out.append(f"""b{k} AS (SELECT e.event_type AS point, h.n + row_number() OVER (PARTITION BY e.event_type
    ORDER BY {_nf('e.ts, e.event_id')}) AS unique_id, e.ts, {rnd('e.value')} AS value
  FROM events e JOIN h{k - 1} h ON e.event_type = h.point
  WHERE e.ts > coalesce(h.hwm + {buffer}, {lb}) AND e.ts < {end}{without})""")
        out.append(f"""h{k} AS (SELECT h.point, coalesce(max(b.ts), h.hwm) AS hwm, h.n + count(b.ts) AS n, count(b.ts) AS fresh
  FROM h{k - 1} h LEFT JOIN b{k} b ON b.point = h.point GROUP BY h.point, h.hwm, h.n)""")
    union = " UNION ALL ".join(f"SELECT * FROM b{k}" for k in range(1, len(as_of) + 1))
    return ",\n".join([*out, f"staged AS ({union})"])


def _sql() -> dict[str, str]:
    cut = _ts(S.KEPT_AS_OF[-1] - dt.timedelta(days=S.KEPT_WINDOW_DAYS))
    kept = f"WITH {runs_sql(S.KEPT_AS_OF, S.KEPT_WINDOW_DAYS)},\nkept AS (SELECT * FROM staged WHERE ts >= {cut})"
    failed = f"('{S.BROKEN}', '{S.ABSENT}')"
    scans = runs_sql(S.SCAN_AS_OF, 30, {2: [S.BROKEN, S.ABSENT]})
    deep = f"""CAST("timestamp" AS DATE) >= DATE '{S.DEEP_START}' AND CAST("timestamp" AS DATE) <= DATE '{S.DEEP_END}'"""
    page = f'ORDER BY "timestamp" DESC NULLS LAST, unique_id ASC LIMIT {S.DEEP_LIMIT} OFFSET {S.DEEP_OFFSET}'
    listed = f"""WITH m AS (SELECT s_suppkey AS key, n_name AS biome, s_suppkey % {S.SHORT_EVERY} = 0 AS few,
    s_suppkey % {S.LONG_EVERY} = 0 AS many FROM supplier JOIN nation ON s_nationkey = n_nationkey)"""
    good = "NOT few AND NOT many"
    return {
        "deep_page": f"SELECT * FROM {ALIGNED5} a {page}",

        "deep_page_dates": f"SELECT * FROM {ALIGNED5} a WHERE {deep} {page}",

        "deep_page_total": f"""SELECT {S.DEEP_LIMIT} AS "limit", {S.DEEP_OFFSET} AS "offset", count(*) AS total_count,
  {S.DEEP_LIMIT + S.DEEP_OFFSET} < count(*) AS has_more FROM {ALIGNED5} a WHERE {deep}""",

        "bitmap_id_counts": f"""SELECT point, count(DISTINCT unique_id) AS unique_ids_count FROM {S5} s GROUP BY point
UNION ALL SELECT 'all', count(DISTINCT unique_id) FROM {S5} s""",

        "bitmap_first_ids": f"SELECT DISTINCT unique_id FROM {S5} s ORDER BY unique_id LIMIT {S.BITMAP_LIMIT}",

        "late_rows_tree": OTHER_SQL["late_rows_audit"],

        "manifest_points": f"""{listed}
SELECT ' P_' || key || ' ' AS point, biome FROM m WHERE {good} AND biome = '{S.MANIFEST_BIOME}'""",

        "manifest_rejects": f"""{listed}
SELECT CASE WHEN few THEN biome ELSE biome || ',' || key || ',x,y' END AS record,
  CAST(CASE WHEN few THEN 1 ELSE 4 END AS INTEGER) AS fields, 3 AS expected FROM m WHERE few OR many""",

        "manifest_order": f"""{listed}
SELECT biome AS category, 'p_' || key AS point, CAST(row_number() OVER (PARTITION BY biome
  ORDER BY key % {S.MANIFEST_FILES}, key) AS INTEGER) AS ord FROM m WHERE {good}""",

        "normalised_points": OTHER_SQL["extract_first_run"],

        "exported_csv": f"""WITH {runs_sql(S.KEPT_AS_OF[1:], 30)}
SELECT * FROM {spread('staged', EVENT_TYPES, ts='ts')}""",

        "existing_tables": f"SELECT * FROM {S5} s WHERE point <> '{S.ABSENT}'",

        "stateful_stream": OTHER_SQL["stream_extract"],

        "stateful_stream_state": f"""SELECT point, max(ts) AS newest, count(*) AS last_used_id
FROM ({OTHER_SQL["stream_extract"]}) s GROUP BY point""",

        "blocks_aligned": f"""{kept},
ids AS (SELECT unique_id FROM kept GROUP BY unique_id HAVING count(*) = (SELECT count(*) FROM pts)),
base AS (SELECT unique_id, ts AS "timestamp" FROM kept WHERE point = (SELECT min(point) FROM pts))
SELECT pv.*, base."timestamp" FROM {spread("kept", EVENT_TYPES)} pv JOIN ids USING (unique_id) JOIN base USING (unique_id)""",

        "blocks_ragged": f"{kept}\nSELECT * FROM {spread('kept', EVENT_TYPES, ts='ts')}",

        "blocks_by_id": f"{kept}\nSELECT * FROM {spread('kept', EVENT_TYPES, ts='ts')} WHERE unique_id = {S.BLOCK_ID}",

        "kept_column_stats": f"""{kept}
SELECT point, min(value) AS min_value, max(value) AS max_value,
  CAST(sum(CAST(value AS DECIMAL(38,2))) AS DOUBLE) / count(value) AS avg_value, count(value) AS non_null_count
FROM kept GROUP BY point""",

        "kept_time_stats": f"""{kept}
SELECT point, min(ts) AS start_time, max(ts) AS end_time, count(*) AS total_records,
  count(DISTINCT unique_id) AS unique_ids_count, count(DISTINCT CAST(ts AS DATE)) AS unique_days,
  min(unique_id) AS first_id, max(unique_id) AS last_id
FROM kept GROUP BY point""",

        "kept_inventory": f"""{kept}
SELECT point AS table_name, count(*) AS row_count FROM kept GROUP BY point""",

        "scan_failed_status": f"""WITH {scans}
SELECT point, fresh AS new_rows, point IN {failed} AS failed, DATE '{S.SCAN_AS_OF[1]}' AS last_run_date,
  {_ts(S.at_noon(S.SCAN_AS_OF[1]))} AS last_run_timestamp, n AS last_used_id FROM h2""",

        "scan_failed_rows": f"WITH {scans}\nSELECT * FROM staged",
    }


ORACLE_SQL = _sql()
