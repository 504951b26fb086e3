"""The same queries as SQL for an independent engine.

Written from the definitions, not from the Spark code: windows are numbered
rows joined as-of, the incident log is spelled out, and every step is a CTE.
"""

from __future__ import annotations

from tidewatch.plans import workload as w

ORACLE: dict[str, str] = {}

NOW = "TIMESTAMP '2024-01-30 23:59:59'"
ORDERS_NOW = "TIMESTAMP '2001-08-05 00:00:00'"
BUCKETS = ("critical_higher", "critical_lower", "warning_higher", "warning_lower")


def _add(name: str, sql: str) -> None:
    ORACLE[name] = sql


def _quote(value) -> str:
    if value is None:
        return "NULL"
    return f"'{value}'" if isinstance(value, str) else f"CAST({value} AS DOUBLE)"


def _values(name: str, columns: str, rows: list[tuple]) -> str:
    body = ", ".join("(" + ", ".join(_quote(v) for v in row) + ")" for row in rows)
    return f"{name}({columns}) AS (VALUES {body})"


def _with(*parts: str, final: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n" + final


# --- metric points ---------------------------------------------------------------


def _event_points(name: str, value: str, period: str = "day", dim: str = "''", where: str = "TRUE") -> str:
    return (f"SELECT '{name}' AS config_name, {dim} AS dimension_split_value, date_trunc('{period}', ts) AS timestamp, "
            f"CAST({value} AS DOUBLE) AS value FROM events WHERE ts >= TIMESTAMP '2024-01-01' AND {where} GROUP BY ALL")


BY_TYPE = _event_points(w.BY_TYPE, "count(*)", dim="event_type")
TOTAL = _event_points(w.TOTAL, "count(*)")
HOURLY = _event_points(w.HOURLY, "sum(value)", "hour")
RATIO = _event_points(w.RATIO, "count(*) FILTER (event_type = 'error') / count(*)")
POINT = "config_name, dimension_split_value, timestamp"

_add("actuals_daily_by_dim", BY_TYPE)
_add("actuals_hourly_total", f"SELECT {POINT}, round(value, 2) AS value FROM ({HOURLY})")
_add("actuals_min", _event_points("events_min_value_daily", "min(value)", dim="event_type"))
_add("actuals_ratio", f"SELECT {POINT}, round(value, 6) AS value FROM ({RATIO})")
_FILTERED = _event_points("events_filtered_daily", "sum(value)", dim="event_type",
                          where="ts >= TIMESTAMP '2024-01-05' AND event_type NOT IN ('view', 'click') "
                                "AND value > 10 AND user_id <> 7")
_add("actuals_filtered", f"SELECT {POINT}, round(value, 2) AS value FROM ({_FILTERED})")
_add("actuals_shared_scan", f"SELECT {POINT}, round(value, 2) AS value FROM (" + " UNION ALL ".join(
    _event_points(f"events_{n}", v, dim="event_type") for n, v in
    (("n", "count(*)"), ("total", "sum(value)"), ("least", "min(value)"), ("most", "max(value)"))) + ")")
_add("actuals_custom_sql", """
SELECT 'orders_price_by_status' AS config_name, o_orderstatus AS dimension_split_value,
       date_trunc('month', o_orderdate) AS timestamp, round(sum(o_totalprice), 2) AS value
FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01' GROUP BY ALL""")
_add("actuals_custom_sql_delta", """
WITH monthly AS (SELECT *, CAST(date_trunc('month', o_orderdate) AS TIMESTAMP) AS mon FROM orders)
SELECT 'orders_price_monthly' AS config_name, o_orderstatus AS dimension_split_value, mon AS timestamp,
       round(sum(o_totalprice), 2) AS value
FROM monthly
WHERE mon BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '2001-08-01' AND mon NOT IN (
  SELECT mon FROM monthly WHERE o_totalprice > 300000 AND month(o_orderdate) <> 7 AND o_orderdate < TIMESTAMP '2001-08-05')
GROUP BY ALL""")
_add("actuals_from_yaml", """
SELECT 'orders_open_weekly' AS config_name, o_orderpriority AS dimension_split_value,
       date_trunc('week', o_orderdate + INTERVAL 1 DAY) - INTERVAL 1 DAY AS timestamp,
       CAST(count(DISTINCT o_custkey) AS DOUBLE) AS value
FROM orders WHERE o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderstatus = 'O' GROUP BY ALL
UNION ALL
SELECT 'events_value_quarterly', '', date_trunc('quarter', ts), max(value) - min(value)
FROM events WHERE ts >= TIMESTAMP '2024-01-01' GROUP BY ALL""")
_add("actuals_drop_unfinal", f"""
SELECT {POINT}, round(value, 2) AS value FROM ({HOURLY})
QUALIFY row_number() OVER (ORDER BY timestamp DESC) > 3""")
_add("actuals_calendar_periods", " UNION ALL ".join(
    f"SELECT 'orders_per_{p}' AS config_name, '' AS dimension_split_value, {cut} AS timestamp, "
    f"CAST(count(*) AS DOUBLE) AS value FROM orders GROUP BY ALL" for p, cut in (
        ("week", "date_trunc('week', o_orderdate + INTERVAL 1 DAY) - INTERVAL 1 DAY"),
        *[(p, f"CAST(date_trunc('{p}', o_orderdate) AS TIMESTAMP)") for p in ("month", "quarter", "year")])))
_add("actuals_delta_load", f"""
SELECT * FROM ({BY_TYPE}) WHERE timestamp NOT IN (SELECT date_trunc('day', ts) FROM events WHERE value > 250)""")

# --- grids -----------------------------------------------------------------------

_HOURS = f"""
grid AS (SELECT '{w.HOURLY}' AS config_name,
                unnest(generate_series(TIMESTAMP '2024-01-01', {NOW}, INTERVAL 1 HOUR)) AS timestamp),
held AS (SELECT DISTINCT date_trunc('hour', ts) AS timestamp FROM events WHERE value > 120)"""
_add("missing_periods_hourly", _with(_HOURS, final="""
SELECT * FROM grid WHERE timestamp NOT IN (SELECT timestamp FROM held)"""))
_add("refetch_window", _with(_HOURS, final="""
SELECT * FROM grid WHERE timestamp NOT IN (SELECT timestamp FROM held)
   OR timestamp >= TIMESTAMP '2024-01-25 23:00:00'"""))
_add("retained_periods_hourly", _with(_HOURS, final=f"""
SELECT '{w.HOURLY}' AS config_name, timestamp FROM held WHERE timestamp < TIMESTAMP '2024-01-25 23:00:00'"""))
_add("forecast_periods", f"""
SELECT '{w.BY_TYPE}' AS config_name, event_type AS dimension_split_value,
       TIMESTAMP '2024-01-23' + to_days(CAST(i AS INTEGER)) AS timestamp, i AS period_index
FROM (SELECT DISTINCT event_type FROM events), range(8) AS r(i)""")

# --- versions --------------------------------------------------------------------

_FIRST, _OPEN, _CLOSED = "TIMESTAMP '2024-01-20 14:00:00'", "'9999-12-31 23:59:59'", "'2024-01-30 23:59:59'"


def _loads(name: str, dim: str, split: str) -> str:
    return f"""
load1_{name} AS ({_event_points(name, 'count(*)', dim=dim, where=f'ts < {_FIRST}')}),
load2_{name} AS ({_event_points(name, 'count(*)', dim=dim)}),
versions_{name} AS (
  SELECT a.config_name, a.dimension_split_value, a.timestamp, a.value, {_FIRST} AS valid_from,
         CASE WHEN a.value <> b.value THEN {_CLOSED} ELSE {_OPEN} END AS valid_to,
         coalesce(a.value = b.value, TRUE) AS is_latest
  FROM load1_{name} a LEFT JOIN load2_{name} b USING (dimension_split_value, timestamp)
  UNION ALL
  SELECT b.config_name, b.dimension_split_value, b.timestamp, b.value, {NOW}, {_OPEN}, TRUE
  FROM load2_{name} b LEFT JOIN load1_{name} a USING (dimension_split_value, timestamp)
  WHERE a.value IS NULL OR a.value <> b.value)"""


_V_TYPE, _V_TOTAL = _loads(w.BY_TYPE, "event_type", "event_type"), _loads(w.TOTAL, "''", "")
_add("row_keys", _with(_V_TYPE, final=f"""
SELECT {POINT}, md5(config_name || '|event_type|' || dimension_split_value || '|' ||
                    strftime(timestamp, '%Y-%m-%d %H:%M:%S.%f')) AS key, md5('') AS source_sql_hash
FROM load1_{w.BY_TYPE}"""))
_add("scd2_upsert", _with(_V_TYPE, final=f"SELECT * FROM versions_{w.BY_TYPE}"))
_add("scd2_noop", _with(_V_TYPE, final=f"SELECT * FROM versions_{w.BY_TYPE}"))
_add("actuals_current", BY_TYPE)
_add("tombstone_config", _with(_V_TYPE, _V_TOTAL, final=f"""
SELECT * FROM versions_{w.BY_TYPE} UNION ALL SELECT * REPLACE (FALSE AS is_latest) FROM versions_{w.TOTAL}"""))

# --- forecasts -------------------------------------------------------------------


def _points(*names: str, p: str = "") -> str:
    sources = {w.BY_TYPE: BY_TYPE, w.TOTAL: TOTAL, w.HOURLY: HOURLY, w.RATIO: RATIO}
    return f"{p}pts AS (" + " UNION ALL ".join(sources[n] for n in names) + ")"


def _grid(start: str, end: str, step: str, where: str = "TRUE", name: str = "grid", p: str = "") -> str:
    return (f"{p}{name} AS (SELECT DISTINCT config_name, dimension_split_value, g.timestamp FROM {p}pts, "
            f"(SELECT unnest(generate_series({start}, {end}, INTERVAL 1 {step})) AS timestamp) g WHERE {where})")


def _statistics(rows: int, methods: dict[str, str], where: str = "TRUE", name: str = "stats", p: str = "") -> str:
    columns = ", ".join(f"{sql} OVER last_rows AS {m}" for m, sql in methods.items())
    return f"""{p}{name} AS (
  SELECT {POINT}, row_number() OVER (PARTITION BY config_name, dimension_split_value ORDER BY timestamp) AS idx,
         {columns}
  FROM {p}pts WHERE {where}
  WINDOW last_rows AS (PARTITION BY config_name, dimension_split_value ORDER BY timestamp
                       ROWS BETWEEN {rows - 1} PRECEDING AND CURRENT ROW))"""


def _as_of(rows: int, methods: list[str], grid: str = "grid", stats: str = "stats") -> str:
    return " UNION ALL ".join(f"""
SELECT g.config_name, g.dimension_split_value, g.timestamp, '{m}' AS forecast_method, CAST(s.{m} AS DOUBLE) AS value
FROM {grid} g ASOF JOIN {stats} s ON g.config_name = s.config_name
     AND g.dimension_split_value = s.dimension_split_value AND g.timestamp > s.timestamp
WHERE s.idx >= {rows}""" for m in methods)


FORECAST = "config_name, dimension_split_value, timestamp, forecast_method, value"
_SQL = {"mean": "avg(value)", "median": "median(value)", "max": "max(value)", "min": "min(value)", "sum": "sum(value)"}
_PRIORITY = """pts AS (SELECT 'orders_by_priority_daily' AS config_name, o_orderpriority AS dimension_split_value,
       date_trunc('day', o_orderdate) AS timestamp, CAST(count(*) AS DOUBLE) AS value FROM orders GROUP BY ALL)"""
_ORDERS_GRID = _grid("TIMESTAMP '2001-05-07'", ORDERS_NOW, "DAY")
for _m, _s in _SQL.items():
    _add(f"forecast_{_m}", _with(_PRIORITY, _ORDERS_GRID, _statistics(30, {_m: _s}), final=f"""
SELECT config_name, dimension_split_value, timestamp, forecast_method, round(value, 6) AS value
FROM ({_as_of(30, [_m])})"""))
_add("forecast_without_training", ORACLE["forecast_max"])
_add("forecast_mstl_periods", _with(
    "days AS (SELECT DISTINCT date_trunc('day', o_orderdate) AS day FROM orders WHERE o_orderdate >= TIMESTAMP '2001-01-01')",
    f"horizon AS (SELECT unnest(generate_series(TIMESTAMP '2001-05-07', {ORDERS_NOW}, INTERVAL 1 DAY)) AS timestamp)",
    "counted AS (SELECT timestamp, count(*) AS n FROM horizon JOIN days ON day < timestamp GROUP BY ALL)", final="""
SELECT 'orders_season_' || season AS config_name, '' AS dimension_split_value, timestamp, 'mstl' AS forecast_method
FROM counted, (VALUES (30), (70)) AS s(season) WHERE n >= 2 * season"""))
_add("forecast_constant", _with(_PRIORITY, _ORDERS_GRID, final="""
SELECT config_name, dimension_split_value, timestamp, 'constant_value' AS forecast_method,
       CAST(0.5 AS DOUBLE) AS value FROM grid"""))
_add("forecast_deprecated_dims", _with(
    _PRIORITY.replace("FROM orders", "FROM orders WHERE o_orderpriority NOT IN ('1-URGENT', '5-LOW')"),
    _ORDERS_GRID, _statistics(30, {"median": _SQL["median"]}), final=f"""
SELECT config_name, dimension_split_value, timestamp, forecast_method, round(value, 6) AS value
FROM ({_as_of(30, ['median'])})"""))
_add("forecast_nonnegative", _with(
    """pts AS (SELECT 'orders_surplus_daily' AS config_name, '' AS dimension_split_value,
       date_trunc('day', o_orderdate) AS timestamp,
       CAST(sum(o_totalprice) - count(*) * 250000 AS DOUBLE) AS value FROM orders GROUP BY ALL)""",
    _ORDERS_GRID, _statistics(7, {m: _SQL[m] for m in ("mean", "min", "max")}),
    f"fc AS ({_as_of(7, ['mean', 'min', 'max'])})", final="""
SELECT config_name, dimension_split_value, timestamp, forecast_method,
       round(CASE WHEN value < 0 AND forecast_method = 'mean' THEN 0
                  WHEN value < 0 AND forecast_method = 'min'
                  THEN (SELECT max(p.value) FROM pts p WHERE p.timestamp < fc.timestamp)
                  ELSE value END, 2) AS value
FROM fc"""))


def _event_forecasts(daily: int, hourly: int, names: tuple[str, ...], end: str = NOW, p: str = "") -> list[str]:
    """Points, grids and forecasts of the deployment as CTEs ending in ``fc``."""
    is_hourly = f"config_name = '{w.HOURLY}'"
    both = {m: _SQL[m] for m in ("mean", "median")}
    unions = [_as_of(daily, ["mean", "median"], f"{p}gd", f"{p}sd"), _as_of(hourly, ["mean", "median"], f"{p}gh", f"{p}sh"),
              f"""SELECT config_name, dimension_split_value, timestamp, 'constant_value', CAST(60 AS DOUBLE)
                  FROM {p}gd WHERE config_name = '{w.BY_TYPE}'"""]
    return [_points(*names, p=p),
            _grid("TIMESTAMP '2024-01-01'", end, "DAY", f"NOT {is_hourly}", "gd", p),
            _grid("TIMESTAMP '2024-01-01'", end, "HOUR", is_hourly, "gh", p),
            _statistics(daily, both, f"NOT {is_hourly}", "sd", p), _statistics(hourly, both, is_hourly, "sh", p),
            f"{p}fc AS (" + " UNION ALL ".join(unions) + ")"]


_ALL = (w.BY_TYPE, w.TOTAL, w.HOURLY, w.RATIO)
_CURRENT = _event_forecasts(7, 72, _ALL)
_add("forecast_all_methods", _with(*_CURRENT, final="""
SELECT config_name, dimension_split_value, timestamp, forecast_method, round(value, 6) AS value FROM fc"""))
_add("deltas_drop_future", _with(*_event_forecasts(7, 72, _ALL, "TIMESTAMP '2024-02-03'"), final="""
SELECT config_name, dimension_split_value, timestamp, forecast_method, round(value, 6) AS value
FROM fc JOIN (SELECT config_name, max(timestamp) AS newest FROM pts GROUP BY ALL) USING (config_name)
WHERE timestamp <= newest"""))


def _total_forecast(days: int, tag: str) -> str:
    both = {m: _SQL[m] for m in ("mean", "median")}
    return ",\n".join([
        _statistics(days, both, name=f"s{tag}"),
        f"f{tag} AS (SELECT * REPLACE (round(value, 6) AS value) FROM ({_as_of(days, ['mean', 'median'], 'grid', f's{tag}')}))"])


_add("scd2_forecasts", _with(
    _points(w.TOTAL), _grid("TIMESTAMP '2024-01-01'", NOW, "DAY"), _total_forecast(3, "1"), _total_forecast(7, "2"),
    final=f"""
SELECT a.forecast_method, a.config_name, a.dimension_split_value, a.timestamp, a.value, {_FIRST} AS valid_from,
       CASE WHEN a.value <> b.value THEN {_CLOSED} ELSE {_OPEN} END AS valid_to,
       coalesce(a.value = b.value, TRUE) AS is_latest
FROM f1 a LEFT JOIN f2 b USING (forecast_method, timestamp)
UNION ALL
SELECT b.forecast_method, b.config_name, b.dimension_split_value, b.timestamp, b.value, {NOW}, {_OPEN}, TRUE
FROM f2 b LEFT JOIN f1 a USING (forecast_method, timestamp) WHERE a.value IS NULL OR a.value <> b.value"""))

# --- deltas ----------------------------------------------------------------------

_COLUMNS = {w.BY_TYPE: "event_id", w.TOTAL: "event_id", w.HOURLY: "value", w.RATIO: "event_type"}
_LINEAGE = "CASE config_name " + " ".join(
    f"WHEN '{n}' THEN 'warehouse.events.{c}'" for n, c in _COLUMNS.items()) + " END"


def _matched(p: str = "") -> str:
    return f"""{p}matched AS (
  SELECT coalesce(f.config_name, a.config_name) AS config_name,
         coalesce(f.dimension_split_value, a.dimension_split_value) AS dimension_split_value,
         coalesce(f.timestamp, a.timestamp) AS timestamp, f.forecast_method, f.timestamp AS forecast_timestamp,
         round(f.value, 6) AS forecast_value, a.timestamp AS actual_timestamp,
         round(coalesce(a.value, 0), 6) AS actual_value
  FROM {p}pts a FULL JOIN {p}fc f ON a.config_name = f.config_name
       AND a.dimension_split_value = f.dimension_split_value AND a.timestamp = f.timestamp)"""
_add("deltas_full_join", _with(*_CURRENT, _matched(), final=f"""
SELECT *, strftime(timestamp, '%Y-%m-%d') AS date, 'warehouse.events' AS source_dataset_table,
       {_LINEAGE} AS source_dataset_table_column,
       CASE WHEN config_name = '{w.HOURLY}' THEN 'hour' ELSE 'day' END AS period_length
FROM matched"""))


# Classes of a point in the order in which they are tried, and the side of the bound on which a difference is out.
_TRIED = (("critical_lower", -1), ("warning_lower", -1), ("critical_higher", 1), ("warning_higher", 1))


def _deltas(limits: list[tuple], p: str = "") -> list[str]:
    """The deltas table (``d``) from a list of bounds that points may strike: the first one struck names the class."""
    column = {"critical_lower": 2, "critical_higher": 3, "warning_lower": 4, "warning_higher": 5}
    bounds = [(row[0], row[1], float(place), name, float(side), row[column[name]]) for row in limits
              for place, (name, side) in enumerate(_TRIED) if row[column[name]] is not None]
    own = ", ".join(f"max(bound) FILTER (name = '{name}') AS {name}" for name, _ in _TRIED)
    return [
        _matched(p),
        _values(f"{p}bounds", "config_name, forecast_method, place, name, side, bound", bounds),
        f"{p}own_bounds AS (SELECT config_name, forecast_method, {own} FROM {p}bounds GROUP BY ALL)",
        _values(f"{p}texts", "config_name, description, dq_dashboard_url, text_inject", w.DESCRIPTION_ROWS),
        f"{p}reach AS (SELECT config_name, max(timestamp) AS last_actual FROM {p}pts GROUP BY ALL)",
        f"""{p}gaps AS (
  SELECT m.*, round(actual_value - forecast_value, 6) AS delta,
         CASE WHEN forecast_value <> 0 THEN round((actual_value - forecast_value) / forecast_value, 6) END AS delta_rel,
         row_number() OVER (PARTITION BY config_name, forecast_method, dimension_split_value ORDER BY timestamp) AS n
  FROM {p}matched m JOIN {p}reach USING (config_name) WHERE coalesce(forecast_timestamp <= last_actual, TRUE))""",
        f"""{p}struck AS (
  SELECT g.config_name, g.forecast_method, g.dimension_split_value, g.n, min_by(b.name, b.place) AS kind,
         min_by(b.bound, b.place) AS bound
  FROM {p}gaps g JOIN {p}bounds b USING (config_name, forecast_method)
  WHERE sign(g.delta_rel - b.bound) = b.side GROUP BY ALL)""",
        f"""{p}kinds AS (
  SELECT g.*, coalesce(s.kind, 'normal') AS anomaly_type_lower_higher, coalesce(s.bound, 0) AS exceeded_threshold_lower_higher
  FROM {p}gaps g LEFT JOIN {p}struck s USING (config_name, forecast_method, dimension_split_value, n))""",
        f"""{p}d AS (
  SELECT k.*, o.* EXCLUDE (config_name, forecast_method), t.* EXCLUDE (config_name), CAST(k.timestamp AS DATE) AS day,
         abs(k.delta) AS abs_delta, abs(k.delta_rel) AS abs_delta_rel,
         sign(k.delta_rel) * least(abs(k.delta_rel), 1) AS delta_rel_winsorised,
         split_part(k.anomaly_type_lower_higher, '_', 1) AS anomaly_type,
         CASE WHEN k.anomaly_type_lower_higher <> 'normal' THEN k.delta_rel END AS anomaly_value,
         CASE WHEN k.anomaly_type_lower_higher <> 'normal' THEN sign(k.delta_rel) * least(abs(k.delta_rel), 1) END
           AS anomaly_value_windsorised,
         e.anomaly_type_lower_higher AS before
  FROM {p}kinds k
  LEFT JOIN {p}kinds e ON e.config_name = k.config_name AND e.forecast_method IS NOT DISTINCT FROM k.forecast_method
       AND e.dimension_split_value = k.dimension_split_value AND e.n = k.n - 1
  LEFT JOIN {p}own_bounds o ON o.config_name = k.config_name AND o.forecast_method = k.forecast_method
  LEFT JOIN {p}texts t ON t.config_name = k.config_name)""",
    ]


_add("actuals_stored", _with(_V_TYPE, _V_TOTAL, final=f"SELECT * FROM versions_{w.BY_TYPE} UNION ALL SELECT * FROM versions_{w.TOTAL}"))


def _made_at(tag: str, loads: list[str], end: str) -> str:
    """Forecasts of a run over what it had loaded."""
    p = f"r{tag}_"
    return ",\n".join([
        f"{p}pts AS ({' UNION ALL '.join(f'SELECT * FROM {load}' for load in loads)})",
        _grid("TIMESTAMP '2024-01-01'", end, "DAY", name="grid", p=p),
        _statistics(7, {m: _SQL[m] for m in ("mean", "median")}, name="stats", p=p),
        f"{p}fc AS ({_as_of(7, ['mean', 'median'], f'{p}grid', f'{p}stats')} UNION ALL SELECT config_name, "
        f"dimension_split_value, timestamp, 'constant_value', CAST(60 AS DOUBLE) FROM {p}grid WHERE config_name = '{w.BY_TYPE}')"])


_add("forecasts_stored", _with(
    _V_TYPE, _V_TOTAL, _made_at("1", [f"load1_{n}" for n in (w.BY_TYPE, w.TOTAL)], "TIMESTAMP '2024-01-23'"),
    _made_at("2", [f"load2_{n}" for n in (w.BY_TYPE, w.TOTAL)], NOW), final=f"""
SELECT a.forecast_method, a.config_name, a.dimension_split_value, a.timestamp, a.value, {_FIRST} AS valid_from,
       CASE WHEN a.value <> b.value THEN {_CLOSED} ELSE {_OPEN} END AS valid_to,
       coalesce(a.value = b.value, TRUE) AS is_latest
FROM r1_fc a LEFT JOIN r2_fc b USING (config_name, dimension_split_value, forecast_method, timestamp)
UNION ALL
SELECT b.forecast_method, b.config_name, b.dimension_split_value, b.timestamp, b.value, {NOW}, {_OPEN}, TRUE
FROM r2_fc b LEFT JOIN r1_fc a USING (config_name, dimension_split_value, forecast_method, timestamp)
WHERE a.value IS NULL OR a.value <> b.value"""))

_DELTAS = [*_CURRENT, *_deltas(w.THRESHOLD_ROWS)]
_DELTA = f"""{POINT}, forecast_method, forecast_value, actual_value, delta, delta_rel, abs_delta, abs_delta_rel,
  delta_rel_winsorised, anomaly_type_lower_higher, exceeded_threshold_lower_higher, anomaly_type, anomaly_value,
  anomaly_value_windsorised"""
_add("deltas_table", _with(*_DELTAS, final=f"""
SELECT {_DELTA}, round(forecast_value * (1 + critical_lower), 6) AS critical_lower_value,
       round(forecast_value * (1 + warning_higher), 6) AS warning_higher_value,
       round(forecast_value * warning_lower, 6) AS warning_lower_delta_threshold,
       round(forecast_value * critical_higher, 6) AS critical_higher_delta_threshold,
       description, dq_dashboard_url, text_inject FROM d"""))
# one metric and one method
_ONE = [_points(w.BY_TYPE), _grid("TIMESTAMP '2024-01-01'", NOW, "DAY"), _statistics(7, {"median": _SQL["median"]}),
        f"fc AS ({_as_of(7, ['median'])})", *_deltas(w.THRESHOLD_ROWS)]
_add("deltas_classified", _with(*_ONE, final=f"SELECT {_DELTA} FROM d"))
_add("deltas_stored", _with(*_DELTAS, final=f"""
SELECT {_DELTA}, CASE WHEN anomaly_type_lower_higher <> 'normal' AND before = 'normal'
                      THEN anomaly_type_lower_higher END AS anomaly_type_lower_higher_start,
       CASE WHEN anomaly_type_lower_higher = 'normal' AND before <> 'normal' THEN before END AS anomaly_type_lower_higher_end
FROM d WHERE config_name IN ('{w.BY_TYPE}', '{w.TOTAL}')"""))
_add("deltas_debounced", _with(*_DELTAS, f"""starts AS (
  SELECT *, CASE WHEN anomaly_type_lower_higher <> 'normal' AND before = 'normal'
                 THEN anomaly_type_lower_higher END AS anomaly_type_lower_higher_start,
         CASE WHEN anomaly_type_lower_higher = 'normal' AND before <> 'normal'
              THEN before END AS anomaly_type_lower_higher_end FROM d)""", final=f"""
SELECT {POINT}, forecast_method, anomaly_type_lower_higher, anomaly_type_lower_higher_start,
       anomaly_type_lower_higher_end,
       CASE WHEN anomaly_type_lower_higher_start IS NOT NULL THEN anomaly_value_windsorised END
         AS anomaly_value_windsorised_debounced,
       CASE WHEN anomaly_type_lower_higher_start IS NOT NULL THEN anomaly_value END AS anomaly_value_debounced,
       CASE WHEN anomaly_type_lower_higher_start IS NOT NULL THEN actual_value END AS actual_value_debounced
FROM starts"""))
_add("actuals_not_stale", f"""
WITH both_metrics AS (
  {BY_TYPE} UNION ALL
  SELECT 'orders_by_priority_daily', o_orderpriority, date_trunc('day', o_orderdate), CAST(count(*) AS DOUBLE)
  FROM orders GROUP BY ALL)
SELECT * FROM both_metrics
QUALIFY date_sub('day', max(timestamp) OVER (PARTITION BY config_name), {NOW}) <= 60""")

_LATEST = """latest AS (
  SELECT *, day AS anomaly_date FROM d WHERE forecast_method IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY config_name, day, dimension_split_value, forecast_method
                             ORDER BY timestamp DESC) = 1)"""
_DATE = "strftime(anomaly_date, '%Y-%m-%d') AS anomaly_date"
_ROW = f"""config_name, {_DATE}, dimension_split_value, forecast_method, timestamp, anomaly_type_lower_higher,
  forecast_value, actual_value, delta_rel"""
_add("deltas_latest_per_key", _with(*_DELTAS, _LATEST, final=f"SELECT {_ROW} FROM latest"))


def _counts(column: str = "anomaly_type_lower_higher", prefix: str = "") -> str:
    return ", ".join(f"count(*) FILTER ({column} = '{b}') AS {prefix}{b}" for b in BUCKETS)


def _json(prefix: str = "") -> str:
    return "'{' || " + " || ', ' || ".join(f"'\"{b}\": ' || {prefix}{b}" for b in BUCKETS) + " || '}'"


_add("bucket_counts", _with(*_DELTAS, """latest AS (
  SELECT *, day AS anomaly_date FROM d
  QUALIFY row_number() OVER (PARTITION BY config_name, day, dimension_split_value, forecast_method
                             ORDER BY timestamp DESC) = 1)""", f"""counted AS (
  SELECT config_name, anomaly_date, {_counts()},
         CAST(max(CASE anomaly_type WHEN 'critical' THEN 2 WHEN 'warning' THEN 1 ELSE 0 END) AS INTEGER)
           AS severity_rank FROM latest GROUP BY ALL)""", final=f"""
SELECT * REPLACE (strftime(anomaly_date, '%Y-%m-%d') AS anomaly_date), {_json()} AS counts_json FROM counted"""))

# --- the incident log the earlier deployment left ----------------------------------


_EARLIER = [*_event_forecasts(3, 24, _ALL[:3], p="e_"), *_deltas(w.EARLIER_THRESHOLD_ROWS, "e_")]
_LOG = [*_EARLIER, """earlier AS (
  SELECT *, day AS anomaly_date FROM (
    SELECT * FROM e_d WHERE forecast_method IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY config_name, day, dimension_split_value, forecast_method
                               ORDER BY timestamp DESC) = 1)
  WHERE anomaly_type <> 'normal')""", f"""log_counts AS (
  SELECT config_name, anomaly_date, {_counts()} FROM earlier GROUP BY config_name, anomaly_date),
log_threads AS (
  SELECT *, critical_higher + critical_lower AS n_critical,
         warning_higher + warning_lower AS n_warning, anomaly_date < DATE '2024-01-08' AS marker,
         CAST(anomaly_date AS TIMESTAMP) + INTERVAL 20 HOUR AS opened,
         config_name || '-' || strftime(anomaly_date, '%Y-%m-%d') AS name
  FROM log_counts)""", f"""incidents AS (
  SELECT config_name, anomaly_date, 'C-LOG' AS slack_channel_id,
         CASE WHEN marker THEN 'BOOTSTRAP-' || name || '-00000000' ELSE 'T-' || name END AS slack_ts,
         opened AS opened_at,
         CASE WHEN marker THEN opened WHEN n_critical = 0 THEN opened + INTERVAL 28 HOUR END AS closed_at,
         CASE WHEN marker OR n_critical = 0 THEN 'resolved' ELSE 'open' END AS status,
         CASE WHEN n_warning = 1 THEN 'corrupt' ELSE {_json()} END AS summary_counts_json
  FROM log_threads
  UNION ALL
  SELECT config_name, anomaly_date, 'C-LOG', 'E-' || name, opened - INTERVAL 10 HOUR, opened - INTERVAL 6 HOUR,
         'resolved', {_json()}
  FROM log_threads WHERE NOT marker AND n_critical >= 2)"""]
_EVENTS = """real_keys AS (
  SELECT k.*, i.slack_ts, i.opened_at FROM earlier k JOIN incidents i USING (config_name, anomaly_date)
  WHERE i.slack_ts LIKE 'T-%'),
log_events AS (
  SELECT slack_ts AS incident_slack_ts, dimension_split_value, forecast_method, 'fire' AS kind,
         anomaly_type_lower_higher AS state, opened_at AS posted_at,
         md5('fire|' || slack_ts || '|' || dimension_split_value || '|' || forecast_method) AS client_msg_id
  FROM real_keys
  UNION ALL
  SELECT slack_ts, dimension_split_value, forecast_method, 'severity_change',
         replace(anomaly_type_lower_higher, 'warning', 'critical'), opened_at + INTERVAL 1 HOUR,
         md5('worse|' || slack_ts || '|' || dimension_split_value || '|' || forecast_method)
  FROM real_keys WHERE forecast_method = 'mean' AND anomaly_type_lower_higher LIKE 'warning%'
  UNION ALL
  SELECT slack_ts, dimension_split_value, forecast_method, 'resolve', 'normal', opened_at + INTERVAL 1 HOUR,
         md5('over|' || slack_ts || '|' || dimension_split_value || '|' || forecast_method)
  FROM real_keys WHERE forecast_method = 'median' AND anomaly_type_lower_higher = 'warning_lower'
  UNION ALL
  SELECT slack_ts, dimension_split_value, forecast_method, 'severity_change', 'critical_lower', opened_at,
         md5('tie|' || slack_ts || '|' || dimension_split_value || '|' || forecast_method)
  FROM real_keys WHERE anomaly_type_lower_higher = 'critical_higher'),
announced AS (
  SELECT incident_slack_ts, dimension_split_value, forecast_method, kind AS announced_kind, posted_at,
         CASE WHEN kind = 'resolve' THEN 'normal' ELSE state END AS announced
  FROM log_events
  QUALIFY row_number() OVER (PARTITION BY incident_slack_ts, dimension_split_value, forecast_method
                             ORDER BY posted_at DESC, client_msg_id) = 1)"""
_INCIDENT = f"config_name, {_DATE}, slack_channel_id, slack_ts, opened_at, closed_at, status, summary_counts_json"

_ROWS = [*_DELTAS, *_LOG, f"""interest AS (
  SELECT config_name, day, dimension_split_value, forecast_method
  FROM d LEFT JOIN (SELECT config_name, anomaly_date AS day, bool_or(status = 'open') AS is_open
                    FROM incidents GROUP BY ALL) USING (config_name, day)
  WHERE anomaly_type <> 'normal' GROUP BY ALL
  HAVING bool_or(coalesce(is_open, FALSE) OR timestamp >= {NOW} - INTERVAL 30 DAY))""", f"""row_set AS (
  SELECT d.*, d.day AS anomaly_date FROM d JOIN interest USING (config_name, day, dimension_split_value, forecast_method)
  WHERE d.timestamp >= {NOW} - INTERVAL 30 DAY
  QUALIFY row_number() OVER (PARTITION BY d.config_name, d.day, d.dimension_split_value, d.forecast_method
                             ORDER BY d.timestamp DESC) = 1)"""]
_add("deltas_keys_of_interest", _with(*_ROWS, final=f"SELECT {_ROW} FROM row_set"))

_SILENCED = f"""silenced AS (
  SELECT config_name, anomaly_date FROM incidents WHERE coalesce(slack_ts, '') NOT LIKE 'BOOTSTRAP-%'
  GROUP BY ALL HAVING max(opened_at) <= {NOW} - INTERVAL 168 HOUR AND arg_max(status, opened_at) = 'resolved')"""
_FOUND = f"""found AS (
  SELECT * FROM incidents
  WHERE status = 'open' OR (status = 'resolved' AND closed_at >= {NOW} - INTERVAL 24 HOUR)
  QUALIFY row_number() OVER (PARTITION BY config_name, anomaly_date
                             ORDER BY CASE status WHEN 'open' THEN 0 ELSE 1 END, opened_at DESC) = 1)"""
_FRESH = """fresh AS (
  SELECT DISTINCT config_name FROM row_set WHERE config_name NOT IN (SELECT config_name FROM incidents))"""
_KEPT = """kept AS (
  SELECT * FROM row_set r
  WHERE NOT EXISTS (SELECT 1 FROM silenced s WHERE s.config_name = r.config_name AND s.anomaly_date = r.anomaly_date)
    AND NOT EXISTS (SELECT 1 FROM incidents i WHERE i.config_name = r.config_name AND i.anomaly_date = r.anomaly_date
                    AND starts_with(i.slack_ts, 'BOOTSTRAP-')))"""
_add("silenced_keys", _with(*_LOG, _SILENCED, final=f"SELECT config_name, {_DATE} FROM silenced"))
_add("incident_lookup", _with(*_LOG, _FOUND, final=f"SELECT {_INCIDENT} FROM found"))
_add("announced_state", _with(*_LOG, _EVENTS, final="SELECT * FROM announced"))
_add("stream_announced_state", _with(*_LOG, _EVENTS, final="""
SELECT incident_slack_ts, dimension_split_value, forecast_method, announced, posted_at FROM announced"""))
_add("first_seen_configs", _with(*_ROWS, _FRESH, final="SELECT * FROM fresh"))
_add("incidents_suppressed_keys", _with(*_ROWS, _SILENCED, _KEPT, final=f"SELECT {_ROW} FROM kept"))
_MARKERS = f"""markers AS (
  SELECT config_name, anomaly_date, '' AS slack_channel_id,
         'BOOTSTRAP-' || config_name || '-' || strftime(anomaly_date, '%Y-%m-%d') || '-' || substr(md5(
           'bootstrap|' || config_name || '|' || strftime(anomaly_date, '%Y-%m-%d') || '|2024-01-30T23:59:59'), 1, 8)
           AS slack_ts,
         {NOW} AS opened_at, {NOW} AS closed_at, 'resolved' AS status, {_json()} AS summary_counts_json
  FROM (SELECT config_name, anomaly_date, {_counts()} FROM row_set
        WHERE config_name IN (SELECT config_name FROM fresh) AND anomaly_date < DATE '2024-01-30' GROUP BY ALL))"""
_add("bootstrap_incidents", _with(*_ROWS, _FRESH, _MARKERS, final=f"SELECT {_INCIDENT} FROM markers"))
_add("close_config_incidents", _with(*_LOG, final=f"""
SELECT * REPLACE (strftime(anomaly_date, '%Y-%m-%d') AS anomaly_date,
  CASE WHEN config_name = '{w.BY_TYPE}' AND status = 'open' THEN {NOW} ELSE closed_at END AS closed_at,
  CASE WHEN config_name = '{w.BY_TYPE}' AND status = 'open' THEN 'resolved' ELSE status END AS status)
FROM incidents"""))
_add("unbootstrap_config", _with(*_LOG, final=f"""
SELECT {_INCIDENT} FROM incidents
WHERE NOT (config_name = '{w.BY_TYPE}' AND slack_ts LIKE 'BOOTSTRAP-%')"""))
_CHANNELS = _values("channels", "config_name, environment, slack_channel_id, slack_channel_name, hours", w.CHANNEL_ROWS)
_add("channel_routing", f"WITH {_CHANNELS}, " + f"""
threads AS (SELECT unnest([{', '.join(_quote(n) for n in _ALL)}]) AS config_name),
environments AS (SELECT unnest(['dev', 'staging', 'prod']) AS environment)
SELECT t.config_name, e.environment, coalesce(own.slack_channel_id, shared.slack_channel_id) AS slack_channel_id,
       coalesce(own.slack_channel_name, shared.slack_channel_name) AS slack_channel_name
FROM threads t, environments e
LEFT JOIN channels own ON own.config_name = t.config_name AND own.environment = e.environment
LEFT JOIN channels shared ON shared.config_name IS NULL AND shared.environment = e.environment
WHERE EXISTS (SELECT 1 FROM events)""")


def _state(rows: str) -> list[str]:
    """Threads to visit with their incident and what fires."""
    return [f"""visited AS (
  SELECT config_name, anomaly_date FROM {rows}
  UNION
  SELECT config_name, anomaly_date FROM incidents i WHERE status = 'open'
    AND NOT EXISTS (SELECT 1 FROM silenced s WHERE s.config_name = i.config_name AND s.anomaly_date = i.anomaly_date))""",
            f"""facts AS (
  SELECT config_name, anomaly_date, bool_or(anomaly_type <> 'normal') AS fires,
         max(CASE anomaly_type WHEN 'critical' THEN 2 WHEN 'warning' THEN 1 ELSE 0 END) AS rank,
         any_value(description) AS description, any_value(dq_dashboard_url) AS dq_dashboard_url,
         any_value(text_inject) AS text_inject, {_counts(prefix="initial_")}
  FROM {rows} GROUP BY ALL)""",
            f"""state AS (
  SELECT v.config_name, v.anomaly_date,
         CASE v.config_name WHEN '{w.HOURLY}' THEN 'flat-with-resolve-replies' WHEN '{w.BY_TYPE}' THEN 'thread'
              ELSE 'flat' END AS mode,
         CASE v.config_name WHEN '{w.BY_TYPE}' THEN 'C-TYPES' ELSE 'C-DEV' END AS slack_channel_id,
         coalesce(f.fires, FALSE) AS has_anomaly,
         CASE f.rank WHEN 2 THEN 'critical' WHEN 1 THEN 'warning' ELSE 'normal' END AS severity,
         coalesce(i.status = 'resolved' AND f.fires, FALSE) AS reopened,
         CASE WHEN i.status = 'open' OR f.fires THEN i.slack_ts END AS incident_slack_ts,
         CASE WHEN i.status = 'open' OR f.fires THEN i.summary_counts_json END AS summary_counts_json,
         coalesce((i.status = 'open' OR f.fires) AND i.opened_at <= {NOW} - INTERVAL 168 HOUR, FALSE) AS hard_cap,
         f.description, f.dq_dashboard_url, f.text_inject,
         {', '.join(f'coalesce(f.initial_{b}, 0) AS initial_{b}' for b in BUCKETS)}
  FROM visited v LEFT JOIN facts f USING (config_name, anomaly_date)
       LEFT JOIN found i USING (config_name, anomaly_date))"""]


_VISIT = [*_ROWS, _SILENCED, _KEPT, _FOUND, *_state("kept")]
_add("threads_visited", _with(*_VISIT, final=f"""
SELECT config_name, {_DATE}, mode, slack_channel_id, has_anomaly, severity, reopened, hard_cap, incident_slack_ts
FROM state"""))
_add("reopened_incidents", _with(*_VISIT, final=f"""
SELECT config_name, {_DATE}, incident_slack_ts FROM state WHERE reopened"""))


def _keys(rows: str) -> str:
    return f"""now_rows AS (
  SELECT r.* FROM {rows} r JOIN state s USING (config_name, anomaly_date) WHERE NOT s.hard_cap),
told AS (
  SELECT s.config_name, s.anomaly_date, a.dimension_split_value, a.forecast_method, a.announced
  FROM announced a JOIN state s ON a.incident_slack_ts = s.incident_slack_ts WHERE NOT s.hard_cap),
keyed AS (
  SELECT config_name, anomaly_date, dimension_split_value, forecast_method,
         n.anomaly_type_lower_higher AS current, t.announced, n.config_name IS NOT NULL AS has_row,
         t.config_name IS NOT NULL AS was_announced, n.timestamp, n.forecast_value, n.actual_value, n.delta_rel,
         CASE WHEN NOT has_row THEN NULL
              WHEN current <> 'normal' AND coalesce(t.announced, 'normal') = 'normal' THEN 'fire'
              WHEN current <> 'normal' AND t.announced <> current THEN 'severity_change'
              WHEN current = 'normal' AND t.announced <> 'normal' THEN 'resolve' END AS transition,
         CASE WHEN transition IN ('fire', 'severity_change') THEN current
              WHEN transition = 'resolve' THEN 'normal' ELSE t.announced END AS projected
  FROM now_rows n FULL JOIN told t USING (config_name, anomaly_date, dimension_split_value, forecast_method)),
after AS (
  SELECT config_name, anomaly_date, count(transition) AS transitions,
         count(*) FILTER (was_announced OR transition IS NOT NULL) AS n_keys,
         count(*) FILTER (projected <> 'normal') AS n_firing, {_counts("projected")}
  FROM keyed GROUP BY ALL),
threads AS (
  SELECT s.*, coalesce(a.transitions, 0) AS transitions, coalesce(a.n_keys, 0) AS n_keys,
         coalesce(a.n_firing, 0) AS n_firing, {', '.join(f'coalesce(a.{b}, 0) AS {b}' for b in BUCKETS)},
         NOT hard_cap AND has_anomaly AND incident_slack_ts IS NULL AS opens,
         coalesce(incident_slack_ts, md5(s.config_name || '|' || strftime(s.anomaly_date, '%Y-%m-%d') ||
                                         '|2024-01-30T23:59:59')) AS thread_id,
         hard_cap OR (incident_slack_ts IS NOT NULL AND n_keys > 0 AND n_firing = 0) AS closes,
         transitions > 0 AND coalesce(
           CASE WHEN incident_slack_ts IS NOT NULL THEN summary_counts_json <> {_json('a.')}
                WHEN mode = 'thread' THEN ({', '.join(f'initial_{b}' for b in BUCKETS)})
                                       <> ({', '.join(f'a.{b}' for b in BUCKETS)})
                ELSE TRUE END, TRUE) AS summarises
  FROM state s LEFT JOIN after a USING (config_name, anomaly_date))"""


_add("incident_transitions", _with(*_VISIT, _EVENTS, _keys("kept"), final=f"""
SELECT config_name, {_DATE}, dimension_split_value, forecast_method, current, announced, transition, projected
FROM keyed WHERE was_announced OR transition IS NOT NULL"""))

_LIVE = """live AS (
  SELECT * FROM kept WHERE config_name NOT IN (SELECT config_name FROM fresh) OR anomaly_date >= DATE '2024-01-30')"""
_RUN = [*_ROWS, _SILENCED, _KEPT, _FOUND,
        _FRESH.replace("FROM row_set", "FROM kept"), _LIVE, *_state("live"), _EVENTS, _keys("live")]
_ACTIONS = """actions AS (
  SELECT config_name, anomaly_date, 'open_thread' AS kind, 0 AS phase, mode, slack_channel_id, thread_id,
         coalesce(first_dim, '') AS dimension_split_value, coalesce(first_method, '') AS forecast_method
  FROM openings
  UNION ALL
  SELECT k.config_name, k.anomaly_date, transition, 1, mode, slack_channel_id, thread_id, dimension_split_value,
         forecast_method
  FROM keyed k JOIN threads t USING (config_name, anomaly_date) WHERE transition IS NOT NULL
  UNION ALL
  SELECT config_name, anomaly_date, 'summary', 2, mode, slack_channel_id, thread_id, '', '' FROM threads WHERE summarises
  UNION ALL
  SELECT config_name, anomaly_date, 'close_thread', 3, mode, slack_channel_id, thread_id, '', '' FROM threads
  WHERE closes),
shown AS (
  SELECT *, CASE mode WHEN 'flat' THEN kind IN ('open_thread', 'close_thread')
                 WHEN 'flat-with-resolve-replies' THEN kind NOT IN ('fire', 'summary') ELSE TRUE END AS visible
  FROM actions)"""


def _openings(rows: str) -> str:
    return f"""first_rows AS (
  SELECT * FROM {rows} WHERE anomaly_type <> 'normal'
  QUALIFY row_number() OVER (PARTITION BY config_name, anomaly_date
                             ORDER BY timestamp, dimension_split_value, forecast_method) = 1),
openings AS (
  SELECT t.*, f.dimension_split_value AS first_dim, f.forecast_method AS first_method,
         f.anomaly_type_lower_higher AS first_type, f.timestamp AS first_timestamp, f.delta_rel AS first_delta_rel,
         f.forecast_value AS first_forecast, f.actual_value AS first_actual
  FROM threads t LEFT JOIN first_rows f
       ON t.mode <> 'thread' AND t.config_name = f.config_name AND t.anomaly_date = f.anomaly_date
  WHERE opens)"""


_DECIDED = [*_RUN, _openings("live"), _ACTIONS]
_add("incident_openings", _with(*_DECIDED, final=f"""
SELECT config_name, {_DATE}, mode, slack_channel_id, severity,
       {', '.join(f"CASE WHEN mode = 'thread' THEN initial_{b} ELSE 0 END AS {b}" for b in BUCKETS)},
       mode = 'thread' AS has_counts, mode <> 'thread' AS has_fire_card, coalesce(first_dim, '') AS dimension_split_value,
       coalesce(first_method, '') AS forecast_method, first_type AS anomaly_type_lower_higher,
       first_timestamp AS timestamp, first_delta_rel AS delta_rel FROM openings"""))
_add("incident_summaries", _with(*_DECIDED, final=f"""
SELECT config_name, {_DATE}, mode, thread_id AS incident_slack_ts, {', '.join(BUCKETS)}
FROM threads WHERE summarises"""))
_add("incident_closures", _with(*_DECIDED, final=f"""
SELECT config_name, {_DATE}, thread_id AS incident_slack_ts,
       CASE WHEN hard_cap THEN 'hard_cap' ELSE 'all_resolved' END AS reason FROM threads WHERE closes"""))
_add("actions_by_mode", _with(*_DECIDED, final=f"""
SELECT config_name, {_DATE}, kind, phase, dimension_split_value, forecast_method, mode, slack_channel_id,
       thread_id AS incident_slack_ts, visible FROM shown"""))
_add("incidents_after_run", _with(*_DECIDED, _MARKERS.replace("FROM row_set", "FROM kept"), f"""base AS (
  SELECT * FROM incidents
  UNION ALL
  SELECT config_name, anomaly_date, slack_channel_id, thread_id, {NOW}, NULL, 'open', {_json()}
  FROM (SELECT config_name, anomaly_date, slack_channel_id, thread_id,
               {', '.join(f"CASE WHEN mode = 'thread' THEN initial_{b} ELSE 0 END AS {b}" for b in BUCKETS)}
        FROM openings))""", final=f"""
SELECT b.config_name, strftime(b.anomaly_date, '%Y-%m-%d') AS anomaly_date, b.slack_channel_id, b.slack_ts, b.opened_at,
       CASE WHEN t.closes THEN {NOW} WHEN t.reopened THEN NULL ELSE b.closed_at END AS closed_at,
       CASE WHEN t.closes THEN 'resolved' WHEN t.reopened THEN 'open' ELSE b.status END AS status,
       CASE WHEN t.summarises AND t.mode = 'thread' THEN {_json('t.')} ELSE b.summary_counts_json END
         AS summary_counts_json
FROM base b LEFT JOIN threads t ON b.slack_ts = t.thread_id
UNION ALL
SELECT {_INCIDENT} FROM markers"""))
_add("events_after_run", _with(*_DECIDED, final=f"""
SELECT s.thread_id AS incident_slack_ts, s.config_name, nullif(s.dimension_split_value, '') AS dimension_split_value,
       nullif(s.forecast_method, '') AS forecast_method, CAST(s.visible AS INTEGER) AS has_message, s.slack_channel_id,
       s.kind, CASE WHEN s.kind = 'summary' THEN NULL WHEN s.kind = 'resolve' THEN 'normal' ELSE k.current END
         AS anomaly_type_lower_higher,
       CASE WHEN s.kind IN ('severity_change', 'resolve') THEN k.announced END AS previous_anomaly_type_lower_higher,
       CASE WHEN s.kind IN ('fire', 'severity_change') THEN k.timestamp END AS anomaly_timestamp,
       {NOW} AS posted_at,
       md5(s.thread_id || '|' || s.dimension_split_value || '|' || s.forecast_method || '|' || s.kind ||
           '|2024-01-30T23:59:59') AS client_msg_id
FROM shown s LEFT JOIN keyed k ON s.phase = 1 AND s.config_name = k.config_name AND s.anomaly_date = k.anomaly_date
     AND s.dimension_split_value = k.dimension_split_value AND s.forecast_method = k.forecast_method
WHERE s.kind IN ('fire', 'severity_change', 'resolve') OR (s.kind = 'summary' AND s.visible)"""))
_add("events_after_run_parity", _with(*_DECIDED, final="""
SELECT config_name, kind, count(*) AS events FROM shown
WHERE visible AND kind IN ('fire', 'severity_change', 'resolve', 'summary') GROUP BY ALL"""))

_add("incidents_stored", ORACLE["incidents_after_run"])
_add("events_stored", _with(*_DECIDED, final=f"""
SELECT incident_slack_ts, coalesce(dimension_split_value, '') AS dimension_split_value,
       coalesce(forecast_method, '') AS forecast_method, kind, posted_at, client_msg_id FROM log_events
UNION ALL
SELECT slack_ts, '', '', 'summary', opened_at + INTERVAL 3 HOUR, md5('summary|' || slack_ts)
FROM incidents WHERE slack_ts LIKE 'T-%'
UNION ALL
SELECT thread_id, dimension_split_value, forecast_method, kind, {NOW},
       md5(thread_id || '|' || dimension_split_value || '|' || forecast_method || '|' || kind || '|2024-01-30T23:59:59')
FROM shown WHERE kind IN ('fire', 'severity_change', 'resolve') OR (kind = 'summary' AND visible)"""))
_add("outbox_stored", _with(*_DECIDED, final=f"""
SELECT row_number() OVER (ORDER BY s.config_name, s.anomaly_date, s.phase, coalesce(o.first_dim, s.dimension_split_value),
                          coalesce(o.first_method, s.forecast_method)) AS action_seq,
       s.config_name, strftime(s.anomaly_date, '%Y-%m-%d') AS anomaly_date, s.kind, s.dimension_split_value,
       s.forecast_method, s.slack_channel_id, s.thread_id, {NOW} AS decided_at
FROM shown s LEFT JOIN openings o ON s.phase = 0 AND o.config_name = s.config_name AND o.anomaly_date = s.anomaly_date
WHERE s.visible"""))

_REPLAYED = """kept AS (
  SELECT *, day AS anomaly_date FROM d WHERE anomaly_type <> 'normal'
  QUALIFY row_number() OVER (PARTITION BY config_name, day, dimension_split_value, forecast_method
                             ORDER BY timestamp DESC) = 1)"""
_NONE = """incidents AS (SELECT '' AS config_name, DATE '2024-01-01' AS anomaly_date, '' AS slack_ts, '' AS status,
  NOW()::TIMESTAMP AS opened_at, '' AS summary_counts_json WHERE FALSE),
silenced AS (SELECT config_name, anomaly_date FROM incidents), found AS (SELECT * FROM incidents),
announced AS (SELECT '' AS incident_slack_ts, '' AS dimension_split_value, '' AS forecast_method, '' AS announced
  WHERE FALSE)"""
_add("replay_actions", _with(*_DELTAS, _REPLAYED, _NONE, *_state("kept"), _keys("kept"), _openings("kept"), _ACTIONS,
                             final=f"""
SELECT config_name, {_DATE}, kind, phase, dimension_split_value, forecast_method, mode, slack_channel_id,
       thread_id AS incident_slack_ts FROM shown WHERE visible"""))

_add("replay_undated_rows", _with(*_DELTAS, final="""
SELECT DISTINCT config_name, dimension_split_value, forecast_method FROM d
WHERE anomaly_type <> 'normal' AND forecast_method = 'mean'"""))
_add("dry_run", _with(*_DECIDED, final="""
SELECT kind, count(*) AS n FROM shown WHERE visible GROUP BY ALL
UNION ALL SELECT 'incidents', count(*) FROM incidents
UNION ALL SELECT 'events', (SELECT count(*) FROM log_events) + (SELECT count(*) FROM incidents WHERE slack_ts LIKE 'T-%')
UNION ALL SELECT 'outbox', 0"""))
_add("seed_thresholds", _with(_points(*_ALL), """spreads AS (
  SELECT config_name, round(max(value) - min(value), 4) AS spread, count(*) AS n FROM pts GROUP BY ALL)""", final="""
SELECT config_name, 'median' AS forecast_method, -spread AS critical_lower, spread AS critical_higher,
       CASE WHEN n > 100 THEN -spread / 4 END AS warning_lower, CAST(NULL AS DOUBLE) AS warning_higher FROM spreads"""))
_add("seed_descriptions", """
SELECT 'part-' || p_partkey AS config_name, p_name || ', "' || p_brand || '"' || chr(10) || p_type AS description,
       CASE WHEN p_size <= 25 THEN 'https://dq.example/?a=1,2' END AS dq_dashboard_url, CAST(NULL AS VARCHAR) AS text_inject
FROM part""")

# --- messages --------------------------------------------------------------------

_SEP = "%EE%80%80"


def _link(config: str, method: str, dim: str) -> str:
    lead = f"include{_SEP}0{_SEP}IN{_SEP}"
    text = (f"'{{\"PARAM_CONFIG_NAME\":\"' || {config} || '\",\"PARAM_FC\":\"' || {method} || '\",\"PARAM_DIMENSION\":\"' "
            f"|| {dim} || '\"' || CASE WHEN {config} <> '' THEN ',\"df34\":\"{lead}' || {config} || '\"' ELSE '' END "
            f"|| CASE WHEN {dim} <> '' THEN ',\"df43\":\"{lead}' || {dim} || '\"' ELSE '' END || '}}'")
    return (f"'https://datastudio.google.com/u/0/reporting/{w.REPORT}/page/{w.PAGE}?params=' || "
            f"replace(replace(url_encode({text}), '%3A', ':'), '%2C', ',')")


_add("dashboard_links", _with(*_DELTAS, f"""keys AS (
  SELECT DISTINCT config_name, coalesce(forecast_method, '') AS forecast_method, dimension_split_value FROM d)""",
                              final=f"""
SELECT *, {_link('config_name', 'forecast_method', 'dimension_split_value')} AS link FROM keys"""))


def _circle(column: str) -> str:
    return (f"CASE WHEN {column} LIKE 'critical%' THEN ':red_circle:' WHEN {column} LIKE 'warning%' "
            f"THEN ':large_yellow_circle:' ELSE ':large_green_circle:' END")


def _table(prefix: str) -> str:
    """Counts table of a summary or an opener."""
    def cell(bucket: str, width: int) -> str:
        return f"lpad(CAST({prefix}{bucket} AS VARCHAR), {width}, ' ')"
    return ("'```' || chr(10) || '          | higher | lower |' || chr(10) || ' critical | ' || "
            f"{cell('critical_higher', 6)} || ' | ' || {cell('critical_lower', 5)} || ' |' || chr(10) || ' warning  | ' || "
            f"{cell('warning_higher', 6)} || ' | ' || {cell('warning_lower', 5)} || ' |' || chr(10) || '```'")


def _stamp(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S') || '+00:00'"


def _number(column: str) -> str:
    return f"CASE WHEN {column} IS NULL THEN 'None' ELSE CAST({column} AS VARCHAR) END"


def _card(link: str, dim: str, method: str, stamp: str, fc: str, ac: str, rel: str) -> str:
    return (f"CASE WHEN {dim} <> '' THEN '*Dimension*: `' || {dim} || '`' || chr(10) ELSE '' END || '*Method*: ' || {method} "
            f"|| chr(10) || '*Timestamp*: ' || {_stamp(stamp)} || chr(10) || '*Forecast*: ' || {_number(fc)} || chr(10) "
            f"|| '*Actual*: ' || {_number(ac)} || chr(10) || '*Relative delta*: ' || {_number(rel)} || chr(10) "
            f"|| '*Dashboard*: <' || {link} || '|drill in>'")


def _total(prefix: str) -> str:
    return " + ".join(f"{prefix}{b}" for b in BUCKETS)


_OPEN_LINK = _link("o.config_name", "coalesce(first_method, '')", "coalesce(first_dim, '')")
_KEY_LINK = _link("k.config_name", "k.forecast_method", "k.dimension_split_value")
_OPENER = f"""
CASE severity WHEN 'critical' THEN ':red_circle:' WHEN 'warning' THEN ':large_yellow_circle:'
     ELSE ':large_green_circle:' END || ' *Incident*: `' || o.config_name || '`' || chr(10) || '*Data date*: `'
  || strftime(o.anomaly_date, '%Y-%m-%d') || '`' || chr(10) || '*Dashboard*: <' || {_OPEN_LINK}
  || '|Anomaly Detection>' || CASE WHEN trim(coalesce(dq_dashboard_url, '')) <> ''
       THEN chr(10) || '*DQ dashboard*: <' || trim(dq_dashboard_url) || '|open>' ELSE '' END
  || chr(10) || '*Environment*: dev' || chr(10) || '_'
  || coalesce(nullif(description, ''), 'No description available') || '_'
  || CASE WHEN t.mode <> 'thread' THEN chr(10) || '*Anomaly*: ' || first_type || chr(10) ||
       {_card(_OPEN_LINK, "first_dim", "first_method", "first_timestamp", "first_forecast", "first_actual", "first_delta_rel")}
     WHEN {_total('initial_')} > 0 THEN chr(10) || '*State* (' || ({_total('initial_')}) || ' active):' || chr(10) ||
       {_table('initial_')} ELSE '' END
  || CASE WHEN trim(coalesce(text_inject, '')) <> '' THEN chr(10) || chr(10) || trim(text_inject) ELSE '' END"""
_CHANGE = f"""
{_circle('k.announced')} || '→' || {_circle('k.current')} || ' *Severity change*'
  || CASE WHEN k.dimension_split_value <> '' THEN ' `' || k.dimension_split_value || '`' ELSE '' END || ': '
  || k.announced || ' → *' || k.current || '*' || chr(10) || '*Timestamp*: ' || {_stamp('k.timestamp')} || chr(10)
  || '*Forecast*: ' || {_number('k.forecast_value')} || ', *Actual*: ' || {_number('k.actual_value')}
  || ', *Relative delta*: ' || {_number('k.delta_rel')} || chr(10) || '*Dashboard*: <' || {_KEY_LINK} || '|drill in>'"""
_FIRE_TEXT = f"""
{_circle('k.current')} || ' *New*: ' || k.current || chr(10) ||
{_card(_KEY_LINK, "k.dimension_split_value", "k.forecast_method", "k.timestamp", "k.forecast_value", "k.actual_value", "k.delta_rel")}"""
_add("outbox_messages", _with(*_DECIDED, final=f"""
SELECT s.config_name, strftime(s.anomaly_date, '%Y-%m-%d') AS anomaly_date, s.slack_channel_id, s.thread_id,
       s.kind = 'open_thread' AS is_parent, s.kind, s.phase, s.dimension_split_value, s.forecast_method,
       CASE s.kind WHEN 'open_thread' THEN {_OPENER}
            WHEN 'fire' THEN {_FIRE_TEXT}
            WHEN 'severity_change' THEN {_CHANGE}
            WHEN 'resolve' THEN ':large_green_circle: *Resolved*' || CASE WHEN k.dimension_split_value <> ''
              THEN ' `' || k.dimension_split_value || '`' ELSE '' END || ' (was ' || k.announced || ')'
            WHEN 'summary' THEN ':bar_chart: *Summary* (' || ({_total('t.')}) || ' active)' || chr(10) || {_table('t.')}
            ELSE ':white_check_mark: *Incident closed* (' ||
              CASE WHEN t.hard_cap THEN 'hard_cap' ELSE 'all_resolved' END || ')' END AS text
FROM shown s JOIN threads t USING (config_name, anomaly_date)
     LEFT JOIN (SELECT config_name, anomaly_date, first_dim, first_method, first_type, first_timestamp, first_forecast,
                       first_actual, first_delta_rel FROM openings) o
       ON s.phase = 0 AND o.config_name = s.config_name AND o.anomaly_date = s.anomaly_date
     LEFT JOIN keyed k ON s.phase = 1 AND s.config_name = k.config_name AND s.anomaly_date = k.anomaly_date
       AND s.dimension_split_value = k.dimension_split_value AND s.forecast_method = k.forecast_method
WHERE s.visible"""))

# --- analysis --------------------------------------------------------------------

_PUBLISHED = """published AS (
  SELECT o_orderpriority AS dataset, o_orderstatus AS environment, CAST(l_shipdate AS DATE) AS date,
         l_shipdate AS timestamp, CAST(date_sub('hour', o_orderdate, l_shipdate) AS DOUBLE) AS hours
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
observed AS (SELECT * FROM published WHERE hours >= 0 AND date >= DATE '1995-06-01')"""
_add("publication_lags", _with(_PUBLISHED, """delays AS (
  SELECT dataset, hours, count(*) AS n, count_if(date >= DATE '2001-08-07') AS late FROM observed GROUP BY ALL),
cumulated AS (
  SELECT *, sum(n) OVER (PARTITION BY dataset ORDER BY hours) AS up_to, sum(n) OVER (PARTITION BY dataset) AS total
  FROM delays),
per_dataset AS (
  SELECT dataset, CAST(sum(n) AS BIGINT) AS obs, CAST(sum(late) AS BIGINT) AS obs_last_90d, round(min(hours)) AS min_h,
         round(min(hours) FILTER (20 * up_to >= total)) AS p5_h, round(min(hours) FILTER (10 * up_to >= total)) AS p10_h,
         round(min(hours) FILTER (4 * up_to >= total)) AS p25_h, round(min(hours) FILTER (2 * up_to >= total)) AS median_h,
         round(max(hours)) AS max_h FROM cumulated GROUP BY dataset)""", final="""
SELECT dataset, '1995-06-01' AS scraper_started, obs, obs_last_90d, min_h AS expected_delay_hour_suggested,
       CAST(ceil(min_h / 24) AS DOUBLE) AS expected_delay_day_suggested, p5_h, p10_h, p25_h, median_h, max_h,
       CASE WHEN obs < 30 THEN 'INSUFFICIENT_DATA' WHEN obs_last_90d = 0 THEN 'NO_RECENT_DATA'
            WHEN min_h > 336 THEN 'LIKELY_OBSOLETE' WHEN min_h = median_h AND min_h > 168 THEN 'LONG_STABLE_CYCLE'
            ELSE 'OK' END AS flag FROM per_dataset ORDER BY dataset"""))
# per environment the delays in order with how many lie up to each; the middle one is the first with half of them
_add("environment_comparison", _with(_PUBLISHED, *[f"""{e}_counts AS (
  SELECT dataset, hours, count(*) AS n FROM observed WHERE environment = '{e}' GROUP BY ALL),
{e}_lags AS (
  SELECT a.dataset, a.hours, sum(b.n) FILTER (b.hours <= a.hours) AS up_to, sum(b.n) AS total
  FROM {e}_counts a JOIN {e}_counts b USING (dataset) GROUP BY ALL),
{e}_summary AS (
  SELECT dataset, round(min(hours)) AS "{e}_min_h", round(min(hours) FILTER (2 * up_to >= total)) AS "{e}_median_h"
  FROM {e}_lags GROUP BY dataset)""" for e in "FO"],
    """all_of_them AS (SELECT DISTINCT dataset FROM observed)""", final="""
SELECT dataset, dataset IN (SELECT dataset FROM F_summary) AS "in_F", dataset IN (SELECT dataset FROM O_summary) AS "in_O",
       "F_min_h", "O_min_h", "F_median_h", "O_median_h"
FROM all_of_them LEFT JOIN F_summary USING (dataset) LEFT JOIN O_summary USING (dataset) ORDER BY dataset"""))
_add("dedup_new_hashes", _with(*_DELTAS, _PUBLISHED, f"""found AS (
  SELECT config_name, dimension_split_value AS dim, forecast_method AS method, timestamp AS moment,
         anomaly_type_lower_higher AS kind FROM d
  WHERE anomaly_type = 'warning' AND timestamp >= {NOW} - INTERVAL 30 DAY
  UNION ALL
  SELECT DISTINCT 'publication_delays', dataset, 'constant_value', date_trunc('day', timestamp), 'critical_higher'
  FROM published WHERE environment = 'F' AND date >= DATE '1995-06-01' AND hours - 40000 > 1)""", final=f"""
SELECT sha256('[''' || config_name || ''', ''' || dim || ''', ''' || method || ''', datetime.datetime(' || year(moment) ||
         ', ' || month(moment) || ', ' || day(moment) || ', ' || hour(moment) || ', ' || minute(moment) ||
         ', tzinfo=datetime.timezone.utc), ''' || kind || ''']') AS event_hash,
       {NOW} AS processed_at,
       '[backfill] ' || config_name || ' / ' || dim || ' / ' || method || ' / ' || strftime(moment, '%Y-%m-%dT%H:%M:%S') ||
         '+00:00 / ' || kind AS rendered_message
FROM found"""))
_add("dedup_stored", ORACLE["dedup_new_hashes"].replace("anomaly_type = 'warning'", "anomaly_type <> 'normal'"))

# --- status views ----------------------------------------------------------------

_NEWEST = """newest AS (
  SELECT * FROM d WHERE forecast_method IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY config_name, forecast_method, dimension_split_value
                             ORDER BY timestamp DESC) = 1)"""
_add("current_state", _with(*_DELTAS, _NEWEST, final="""
SELECT config_name, dimension_split_value, forecast_method, timestamp, forecast_value, actual_value, delta_rel,
       anomaly_type, anomaly_type_lower_higher FROM newest"""))
_RANK = "CASE anomaly_type WHEN 'critical' THEN 2 WHEN 'warning' THEN 1 ELSE 0 END"


def _severity(column: str) -> str:
    return f"CASE {column} WHEN 2 THEN 'critical' WHEN 1 THEN 'warning' ELSE 'normal' END"


_ROLLUP = f"""rollup_rows AS (
  SELECT config_name, max(worst) AS worst, count(*) FILTER (worst = 2) AS critical_dimensions, count(*) AS dimensions
  FROM (SELECT config_name, dimension_split_value, max({_RANK}) AS worst FROM newest GROUP BY ALL) GROUP BY ALL),
fired AS (SELECT config_name, max(timestamp) AS last_fired FROM d WHERE anomaly_type <> 'normal' GROUP BY ALL)"""
_add("config_rollup", _with(*_DELTAS, _NEWEST, _ROLLUP, final=f"""
SELECT config_name, {_severity('worst')} AS severity, critical_dimensions, dimensions, last_fired
FROM rollup_rows LEFT JOIN fired USING (config_name)"""))
_add("product_rollup", _with(*_DELTAS, _NEWEST, _ROLLUP, _values("products", "config_name, product", w.PRODUCT_ROWS),
                             final=f"""
SELECT coalesce(product, config_name) AS product, {_severity('max(worst)')} AS severity,
       count(*) FILTER (worst > 0) AS affected_configs, count(*) AS configs, max(last_fired) AS last_fired
FROM rollup_rows LEFT JOIN fired USING (config_name) LEFT JOIN products USING (config_name) GROUP BY 1"""))
_add("severity_ribbon_14d", _with(*_DELTAS, final=f"""
SELECT config_name, strftime(day, '%Y-%m-%d') AS date, {_severity(f'max({_RANK})')} AS severity,
       count(*) FILTER (anomaly_type <> 'normal') AS anomalies
FROM d WHERE day >= DATE '2024-01-17' AND day <= DATE '2024-01-30' GROUP BY config_name, day"""))
_add("count_drift", _with(*_LOG, _EVENTS, f"""logged AS (
  SELECT incident_slack_ts, {_counts('announced')} FROM announced GROUP BY ALL),
compared AS (
  SELECT i.*, {', '.join(f"CASE WHEN summary_counts_json = 'corrupt' THEN -1 ELSE CAST(json_extract(CASE WHEN summary_counts_json = 'corrupt' THEN '{{}}' ELSE summary_counts_json END, '$.{b}') AS BIGINT) END AS stored_{b}, coalesce(l.{b}, 0) AS logged_{b}" for b in BUCKETS)}
  FROM incidents i LEFT JOIN logged l ON i.slack_ts = l.incident_slack_ts WHERE i.status = 'open')""", final=f"""
SELECT config_name, {_DATE}, slack_ts, {', '.join(f'stored_{b}, logged_{b}' for b in BUCKETS)} FROM compared
WHERE {' OR '.join(f'stored_{b} <> logged_{b}' for b in BUCKETS)}"""))
_add("stale_dimensions", """
WITH last_seen AS (
  SELECT 'orders_by_customer' AS config_name, CAST(o_custkey AS VARCHAR) AS dimension_split_value,
         max(date_trunc('day', o_orderdate)) AS last_seen FROM orders GROUP BY ALL)
SELECT *, max(last_seen) OVER () AS config_newest,
       date_sub('day', last_seen, max(last_seen) OVER ()) AS periods_behind
FROM last_seen QUALIFY periods_behind >= 30""")

# --- streams ---------------------------------------------------------------------

_add("stream_metric_points", BY_TYPE)
_add("stream_final_points", f"""
SELECT {POINT}, round(value, 2) AS value FROM ({HOURLY})
WHERE timestamp + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 3 HOUR""")
_add("stream_versions", f"SELECT {POINT}, value, TRUE AS is_latest FROM ({TOTAL})")
_add("stream_points_resumed", BY_TYPE)
_add("stream_versions_resumed", f"""
SELECT {POINT}, value, TRUE AS is_latest FROM ({TOTAL})
UNION ALL
SELECT '{w.TOTAL}', '', TIMESTAMP '2024-01-15', count(*)::DOUBLE, FALSE FROM events
WHERE ts >= TIMESTAMP '2024-01-15' AND ts < TIMESTAMP '2024-01-15 12:00:00'
HAVING count(*) > 0 AND count(*) < (SELECT count(*) FROM events WHERE date_trunc('day', ts) = TIMESTAMP '2024-01-15')""")
_add("stream_distinct_hashes", """
SELECT DISTINCT sha256(event_type || '|' || strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S')) AS event_hash
FROM events""")
