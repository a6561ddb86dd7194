"""SQL twin of the feature engine (fit state + transform) for the DuckDB oracles."""

from __future__ import annotations

import math

from .. import constants as K
from .sql import band, norm

TWO_PI = repr(2.0 * math.pi)


def clean_select(src: str, with_target: bool = True) -> str:
    """SQL of ``base_clean`` over a fixture table (typed columns)."""
    tgt = ", posted_rate" if with_target else ""
    return f"""SELECT load_id, date{tgt},
    {norm('pickup')} AS pickup, {norm('delivery')} AS delivery, {norm('equipment')} AS equipment,
    CAST(weight IS NULL AS INTEGER) AS weight_missing,
    CAST(coalesce(weight < 0, false) AS INTEGER) AS weight_sign_corrected,
    CAST(market_index IS NULL AS INTEGER) AS market_index_missing,
    CASE WHEN distance > 0 THEN distance END AS distance, CASE WHEN weight > 0 THEN weight END AS weight,
    CASE WHEN market_index > 0 THEN market_index END AS market_index,
    CASE WHEN quote_signal > 0 THEN quote_signal END AS quote_signal,
    CASE WHEN pickup_lat BETWEEN -90 AND 90 THEN pickup_lat END AS pickup_lat,
    CASE WHEN delivery_lat BETWEEN -90 AND 90 THEN delivery_lat END AS delivery_lat,
    CASE WHEN pickup_lon BETWEEN -180 AND 180 THEN pickup_lon END AS pickup_lon,
    CASE WHEN delivery_lon BETWEEN -180 AND 180 THEN delivery_lon END AS delivery_lon
  FROM {src}"""


def composites(src: str) -> str:
    return f"""SELECT *, pickup || ' > ' || delivery AS route, pickup || ' | ' || equipment AS pickup_equipment,
    delivery || ' | ' || equipment AS delivery_equipment,
    pickup || ' > ' || delivery || ' | ' || equipment AS route_equipment FROM {src}"""


def state_ctes(train: str = "training", prefix: str = "fs") -> str:
    """CTEs ``{prefix}_clean``, ``{prefix}_counts``, ``{prefix}_coords``, ``{prefix}_ref`` fitted on ``train``."""
    p = prefix
    counts = " UNION ALL ".join(
        f"SELECT '{k}' AS key_column, {k} AS key, count(*) AS count,"
        f" count(*) / CAST((SELECT count(*) FROM {train}) AS DOUBLE) AS frequency FROM {p}_keys GROUP BY {k}"
        for k in K.FREQUENCY_KEYS)
    return f"""{p}_clean AS MATERIALIZED ({clean_select(train)}),
{p}_keys AS ({composites(p + '_clean')}),
{p}_counts AS MATERIALIZED ({counts}),
{p}_stack AS (SELECT pickup AS city, pickup_lat AS lat, pickup_lon AS lon FROM {p}_clean
              UNION ALL SELECT delivery, delivery_lat, delivery_lon FROM {p}_clean),
{p}_coords AS MATERIALIZED (SELECT city, quantile_cont(lat, 0.5) AS lat, quantile_cont(lon, 0.5) AS lon FROM {p}_stack
               WHERE lat IS NOT NULL AND lon IS NOT NULL GROUP BY city),
{p}_ref AS (SELECT min(date) AS d FROM {p}_clean)"""


def _hav(p1: str, p2: str, dl: str, dlat: str) -> str:
    a = f"(pow(sin(({dlat}) / 2), 2) + cos({p1}) * cos({p2}) * pow(sin(({dl}) / 2), 2))"
    a = f"least(greatest({a}, 0E0), 1E0)"
    return f"{K.EARTH_RADIUS_MILES} * 2 * atan2(sqrt({a}), sqrt(1 - {a}))"


def transform_ctes(rows: str, with_target: bool, prefix: str = "fs", out: str = "feat") -> str:
    """CTE ``{out}`` = every feature of ``rows`` under the state CTEs of ``prefix``."""
    p = prefix
    freq_joins, freq_cols = [], []
    for i, k in enumerate(K.FREQUENCY_KEYS):
        a = f"c{i}"
        freq_joins.append(f"LEFT JOIN (SELECT key, count, frequency FROM {p}_counts WHERE key_column = '{k}') {a}"
                          f" ON x.{k} = {a}.key")
        freq_cols.append(f"coalesce({a}.frequency, 0E0) AS {k}_frequency")
        if k in K.RARE_KEYS:
            freq_cols.append(f"CAST(coalesce({a}.count, 0) BETWEEN 1 AND {K.RARE_THRESHOLD - 1} AS INTEGER) AS rare_{k}")
            freq_cols.append(f"CAST(coalesce({a}.count, 0) = 0 AS INTEGER) AS unseen_{k}")
    holidays = ", ".join(f"DATE '{h}'" for h in K.FEDERAL_HOLIDAYS)

    def near(anchors):
        return " OR ".join(f"abs(datediff('day', DATE '{a}', date)) <= {K.NEAR_DATE_DAYS}" for a in anchors)

    plat, plon, dlat, dlon = "pickup_lat", "pickup_lon", "delivery_lat", "delivery_lon"
    p1, p2 = f"radians({plat})", f"radians({dlat})"
    dl = f"radians({dlon} - {plon})"
    hav = f"CASE WHEN {plat} IS NULL OR {dlat} IS NULL OR {plon} IS NULL OR {dlon} IS NULL THEN NULL " \
          f"ELSE {_hav(p1, p2, dl, f'{p2} - {p1}')} END"
    bearing = f"atan2(sin({dl}) * cos({p2}), cos({p1}) * sin({p2}) - sin({p1}) * cos({p2}) * cos({dl}))"
    return f"""{out}_c AS ({clean_select(rows, with_target)}),
{out}_e AS (SELECT c.* REPLACE (coalesce(c.pickup_lat, pc.lat) AS pickup_lat, coalesce(c.pickup_lon, pc.lon) AS pickup_lon,
                                 coalesce(c.delivery_lat, dc.lat) AS delivery_lat, coalesce(c.delivery_lon, dc.lon) AS delivery_lon)
            FROM {out}_c c LEFT JOIN {p}_coords pc ON c.pickup = pc.city LEFT JOIN {p}_coords dc ON c.delivery = dc.city),
{out}_k AS ({composites(out + '_e')}),
{out}_g AS (SELECT *, {hav} AS haversine_distance, {bearing} AS bearing FROM {out}_k),
{out} AS (SELECT x.*,
    CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month, CAST(quarter(date) AS INTEGER) AS quarter,
    CAST(weekofyear(date) AS INTEGER) AS week_of_year, CAST(day(date) AS INTEGER) AS day_of_month,
    CAST(dayofyear(date) AS INTEGER) AS day_of_year, CAST(isodow(date) - 1 AS INTEGER) AS day_of_week,
    CAST(isodow(date) - 1 >= 5 AS INTEGER) AS weekend, CAST(day(date) = 1 AS INTEGER) AS month_start,
    CAST(last_day(date) = date AS INTEGER) AS month_end,
    CAST(datediff('day', (SELECT d FROM {p}_ref), date) AS INTEGER) AS days_since_start,
    sin({TWO_PI} * month(date) / 12E0) AS month_sin, cos({TWO_PI} * month(date) / 12E0) AS month_cos,
    sin({TWO_PI} * (isodow(date) - 1) / 7E0) AS weekday_sin, cos({TWO_PI} * (isodow(date) - 1) / 7E0) AS weekday_cos,
    sin({TWO_PI} * dayofyear(date) / 365.25E0) AS annual_sin, cos({TWO_PI} * dayofyear(date) / 365.25E0) AS annual_cos,
    CAST(date IN ({holidays}) AS INTEGER) AS federal_holiday,
    CAST({near(K.THANKSGIVING)} AS INTEGER) AS near_thanksgiving, CAST({near(K.CHRISTMAS)} AS INTEGER) AS near_christmas,
    distance - haversine_distance AS distance_haversine_difference,
    distance / CASE WHEN haversine_distance IS NULL THEN NULL ELSE greatest(haversine_distance, 1E0) END
      AS distance_haversine_ratio,
    {dlat} - {plat} AS latitude_difference, {dlon} - {plon} AS longitude_difference,
    abs({dlat} - {plat}) AS absolute_latitude_difference, abs({dlon} - {plon}) AS absolute_longitude_difference,
    ({plat} + {dlat}) / 2 AS midpoint_latitude, ({plon} + {dlon}) / 2 AS midpoint_longitude,
    sin(bearing) AS bearing_sin, cos(bearing) AS bearing_cos, {band('distance')} AS distance_band,
    ln(1 + distance) AS log_distance, ln(1 + weight) AS log_weight, pow(distance, 2) / 1000E0 AS distance_squared_scaled,
    weight / CASE WHEN distance IS NULL THEN NULL ELSE greatest(distance, 1E0) END AS weight_to_distance,
    distance * market_index AS distance_market_index, distance * quote_signal AS distance_quote_signal,
    market_index * quote_signal AS market_quote_interaction,
    equipment || ' | ' || {band('distance')} AS equipment_distance_band,
    {', '.join(freq_cols)}
  FROM {out}_g x {' '.join(freq_joins)})"""
