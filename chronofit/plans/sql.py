"""DuckDB oracle SQL builders: the fixture CTEs and shared expression snippets.

The oracles are independent re-statements of each query in plain SQL over the
driver's parquet views; the driver runs them next to the Spark queries.
"""

from __future__ import annotations

from .. import constants as K
from ..sources.fixture import RENAMED, RENAMED_CITIES, VALIDATION_START

LOADS_SQL = f"""loads AS MATERIALIZED (
  WITH numbered AS (
    SELECT l.*, row_number() OVER (
        PARTITION BY l_orderkey, l_linenumber, l_partkey, l_suppkey
        ORDER BY l_shipdate, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus) AS dup_no
    FROM lineitem l),
  keyed AS (
    SELECT n.*, p_size, s_nationkey*4 + s_suppkey % 4 AS pk, c_nationkey*4 + c_custkey % 4 AS dk,
           s_nationkey, s_suppkey % 4 AS s4, c_nationkey, c_custkey % 4 AS c4, CAST(l_shipdate AS DATE) >= DATE '{VALIDATION_START}' AS renamed
    FROM numbered n JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
         JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey)
  SELECT concat_ws('-', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR), CAST(l_partkey AS VARCHAR),
                   CAST(l_suppkey AS VARCHAR), CAST(dup_no AS VARCHAR)) AS load_id,
    CAST(pk AS INT) AS pickup_key, CAST(dk AS INT) AS delivery_key,
    concat('NATION_', CAST(s_nationkey AS VARCHAR), '  ', CAST(s4 AS VARCHAR), CASE WHEN renamed AND pk >= {RENAMED_CITIES} THEN '{RENAMED}' ELSE '' END) AS pickup,
    concat(' nation_', CAST(c_nationkey AS VARCHAR), ' ', CAST(c4 AS VARCHAR), CASE WHEN renamed AND dk >= {RENAMED_CITIES} THEN '{RENAMED}' ELSE '' END) AS delivery,
    25E0 + (pk*7 % 25) AS pickup_lat, -120E0 + (pk*11 % 50) AS pickup_lon,
    25E0 + (dk*7 % 25) AS delivery_lat, -120E0 + (dk*11 % 50) AS delivery_lon,
    50E0 + 40E0*l_quantity AS distance,
    CASE l_returnflag WHEN 'A' THEN 'dry van' WHEN 'N' THEN ' REEFER ' ELSE 'Flatbed' END AS equipment,
    CASE WHEN l_partkey % 97 = 0 THEN NULL WHEN l_partkey % 89 = 1 THEN -900E0*p_size ELSE 900E0*p_size END AS weight,
    CAST(l_shipdate AS DATE) AS date,
    CASE WHEN l_orderkey % 101 = 0 THEN NULL ELSE 12E-1 - l_discount END AS market_index,
    15E-1 + 10E0*l_tax AS quote_signal,
    (50E0 + 40E0*l_quantity) * (24E-1 + CASE l_returnflag WHEN 'A' THEN 2E-1 WHEN 'N' THEN 5E-1 ELSE 8E-1 END
       + 5E0*l_tax - l_discount) + l_extendedprice/1000E0 AS posted_rate
  FROM keyed)"""

_COLS = ", ".join(K.LOAD_COLUMNS)

DEV_SQL = f"""development AS (
  SELECT {_COLS}, posted_rate FROM loads
  WHERE date < DATE '{VALIDATION_START}')"""
VAL_SQL = f"""validation AS (SELECT {_COLS} FROM loads WHERE date >= DATE '{VALIDATION_START}')"""

# Outer split: cutoff = last labeled day - (validation span in days).
SPLIT_SQL = """cut AS (SELECT (SELECT max(date) FROM development)
                    - CAST((SELECT datediff('day', min(date), max(date)) FROM validation) AS INTEGER) AS cutoff),
training AS (SELECT * FROM development WHERE date < (SELECT cutoff FROM cut)),
holdout AS (SELECT * FROM development WHERE date >= (SELECT cutoff FROM cut))"""

INNER_SQL = f"""icut AS (SELECT (SELECT max(date) FROM training) - {K.INNER_HORIZON_DAYS - 1} AS cutoff),
inner_training AS (SELECT * FROM training WHERE date < (SELECT cutoff FROM icut)),
inner_validation AS (SELECT * FROM training WHERE date >= (SELECT cutoff FROM icut))"""


def with_fixture(*ctes: str) -> str:
    return "WITH " + ",\n".join([LOADS_SQL, DEV_SQL, VAL_SQL, *ctes])


def norm(col: str) -> str:
    """SQL twin of ``normalise_category``: Unknown, squeeze whitespace, trim, title case."""
    sq = f"trim(regexp_replace(coalesce(CAST({col} AS VARCHAR), 'Unknown'), '\\s+', ' ', 'g'))"
    title = (f"array_to_string(list_transform(regexp_extract_all(lower({sq}), '(\\p{{L}}+|[^\\p{{L}}]+)'), "
             f"lambda t: upper(substr(t, 1, 1)) || substr(t, 2)), '')")
    return f"(CASE WHEN {sq} = '' THEN 'Unknown' ELSE {title} END)"


def band(col: str) -> str:
    e, lab = K.DISTANCE_BAND_EDGES, K.DISTANCE_BAND_LABELS
    return (f"(CASE WHEN {col} IS NULL THEN 'Unknown' WHEN {col} <= {e[0]} THEN '{lab[0]}' "
            f"WHEN {col} <= {e[1]} THEN '{lab[1]}' WHEN {col} <= {e[2]} THEN '{lab[2]}' ELSE '{lab[3]}' END)")


def metrics(y: str = "actual", p: str = "predicted", rows: bool = True, bias: bool = True) -> str:
    e = f"({p} - {y})"
    sse = f"sum({e} * {e})"
    sst = f"(var_pop({y}) * count(*))"
    parts = []
    if rows:
        parts.append("count(*) AS rows")
    parts += [
        f"avg(abs({e})) AS mae",
        f"sqrt(avg({e} * {e})) AS rmse",
        f"CASE WHEN {sst} > 0 THEN 1 - {sse} / {sst} WHEN {sse} = 0 THEN 1E0 ELSE 0E0 END AS r2",
        f"avg(CASE WHEN abs({y}) + abs({p}) > 0 THEN 2E0 * abs({e}) / (abs({y}) + abs({p})) ELSE 0E0 END) * 100E0 AS smape",
    ]
    if bias:
        parts.append(f"avg({e}) AS mean_error")
    return ", ".join(parts)


def rounded(select_sql: str, cols_double: list[str], cols_other: list[str], digits: int = 6) -> str:
    """Wrap a query so its DOUBLE columns are rounded like the Spark side."""
    # "+ 0E0" turns a rounded -0.0 into 0.0 (Spark's rounding never yields -0.0).
    cols = cols_other + [f"round({c}, {digits}) + 0E0 AS {c}" for c in cols_double]
    return f"SELECT {', '.join(cols)} FROM ({select_sql}) q"


SCENARIO_SQL = f"""sdev AS (SELECT {norm('pickup')} AS pickup, {norm('delivery')} AS delivery,
                    {norm('equipment')} AS equipment, distance, weight FROM development),
top_route AS (SELECT pickup, delivery FROM sdev GROUP BY pickup, delivery
              ORDER BY count(*) DESC, pickup, delivery LIMIT 1),
on_route AS (SELECT s.* FROM sdev s JOIN top_route USING (pickup, delivery)),
top_eq AS (SELECT equipment FROM on_route GROUP BY equipment ORDER BY count(*) DESC, equipment LIMIT 1),
smonth AS (SELECT CAST(date_trunc('month', max(date)) AS DATE) AS m FROM validation),
scenario AS (
  SELECT (SELECT pickup FROM top_route) AS pickup, (SELECT delivery FROM top_route) AS delivery,
         (SELECT quantile_cont(distance, 0.5) FROM on_route) AS distance, (SELECT equipment FROM top_eq) AS equipment,
         (SELECT quantile_cont(CASE WHEN weight > 0 THEN weight END, 0.5) FROM on_route) AS weight,
         CAST(t.d AS DATE) AS date
  FROM generate_series(CAST((SELECT m FROM smonth) AS TIMESTAMP),
                       CAST(last_day((SELECT m FROM smonth)) AS TIMESTAMP), INTERVAL 1 DAY) AS t(d))"""
