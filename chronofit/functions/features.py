"""Column expressions for date, geographic and interaction features and bands."""

from __future__ import annotations

import math
from typing import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import constants as K

TWO_PI = 2.0 * math.pi


def c(name: str) -> Column:
    return F.col(name)


def at_least(x: Column, floor: float) -> Column:
    """max(x, floor) that keeps NULL as NULL (``greatest`` would turn NULL into floor)."""
    return F.when(x.isNotNull(), F.greatest(x, F.lit(floor)))


def distance_band(x: Column, edges: Sequence[float] = K.DISTANCE_BAND_EDGES,
                  labels: Sequence[str] = K.DISTANCE_BAND_LABELS) -> Column:
    """Right-closed bins (-inf, e1], (e1, e2], ...; missing -> Unknown."""
    expr = F.when(x.isNull(), F.lit(K.UNKNOWN))
    for edge, label in zip(edges, labels):
        expr = expr.when(x <= F.lit(edge), F.lit(label))
    return expr.otherwise(F.lit(labels[-1]))


def date_features(d: Column, reference_date, holidays: Sequence[str] = K.FEDERAL_HOLIDAYS,
                  thanksgiving: Sequence[str] = K.THANKSGIVING,
                  christmas: Sequence[str] = K.CHRISTMAS, near_days: int = K.NEAR_DATE_DAYS) -> dict[str, Column]:
    month = F.month(d)
    dow = F.weekday(d)                      # Monday = 0
    doy = F.dayofyear(d)

    def near(anchors: Sequence[str]) -> Column:
        hit = F.lit(False)
        for a in anchors:
            hit = hit | (F.abs(F.datediff(d, F.to_date(F.lit(a)))) <= near_days)
        return hit.cast("int")

    return {
        "year": F.year(d),
        "month": month,
        "quarter": F.quarter(d),
        "week_of_year": F.weekofyear(d),
        "day_of_month": F.dayofmonth(d),
        "day_of_year": doy,
        "day_of_week": dow,
        "weekend": (dow >= 5).cast("int"),
        "month_start": (F.dayofmonth(d) == 1).cast("int"),
        "month_end": (F.last_day(d) == d).cast("int"),
        "days_since_start": F.datediff(d, F.lit(reference_date).cast("date")),
        "month_sin": F.sin(TWO_PI * month / 12.0),
        "month_cos": F.cos(TWO_PI * month / 12.0),
        "weekday_sin": F.sin(TWO_PI * dow / 7.0),
        "weekday_cos": F.cos(TWO_PI * dow / 7.0),
        "annual_sin": F.sin(TWO_PI * doy / 365.25),
        "annual_cos": F.cos(TWO_PI * doy / 365.25),
        "federal_holiday": d.isin(*[F.to_date(F.lit(h)) for h in holidays]).cast("int"),
        "near_thanksgiving": near(thanksgiving),
        "near_christmas": near(christmas),
    }


def haversine(lat1: Column, lon1: Column, lat2: Column, lon2: Column,
              radius: float = K.EARTH_RADIUS_MILES) -> Column:
    p1, p2 = F.radians(lat1), F.radians(lat2)
    dlat = p2 - p1
    dlon = F.radians(lon2 - lon1)
    a = F.pow(F.sin(dlat / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(dlon / 2), 2)
    a = F.least(F.greatest(a, F.lit(0.0)), F.lit(1.0))
    a = F.when(dlat.isNotNull() & dlon.isNotNull(), a)
    return radius * 2 * F.atan2(F.sqrt(a), F.sqrt(1 - a))


def geographic_features(distance: Column) -> dict[str, Column]:
    plat, plon, dlat, dlon = c("pickup_lat"), c("pickup_lon"), c("delivery_lat"), c("delivery_lon")
    hav = haversine(plat, plon, dlat, dlon)
    p1, p2 = F.radians(plat), F.radians(dlat)
    dl = F.radians(dlon - plon)
    bearing = F.atan2(F.sin(dl) * F.cos(p2), F.cos(p1) * F.sin(p2) - F.sin(p1) * F.cos(p2) * F.cos(dl))
    lat_diff, lon_diff = dlat - plat, dlon - plon
    return {
        "haversine_distance": hav,
        "distance_haversine_difference": distance - hav,
        "distance_haversine_ratio": distance / at_least(hav, 1.0),
        "latitude_difference": lat_diff,
        "longitude_difference": lon_diff,
        "absolute_latitude_difference": F.abs(lat_diff),
        "absolute_longitude_difference": F.abs(lon_diff),
        "midpoint_latitude": (plat + dlat) / 2,
        "midpoint_longitude": (plon + dlon) / 2,
        "bearing_sin": F.sin(bearing),
        "bearing_cos": F.cos(bearing),
        "distance_band": distance_band(distance),
    }


def interaction_features() -> dict[str, Column]:
    d, w, m, q = c("distance"), c("weight"), c("market_index"), c("quote_signal")
    return {
        "log_distance": F.log1p(d),
        "log_weight": F.log1p(w),
        "distance_squared_scaled": F.pow(d, 2) / 1000.0,
        "weight_to_distance": w / at_least(d, 1.0),
        "distance_market_index": d * m,
        "distance_quote_signal": d * q,
        "market_quote_interaction": m * q,
        "equipment_distance_band": F.concat(c("equipment"), F.lit(K.COMPOSITE_SEPARATOR), distance_band(d)),
    }


def composite_keys() -> dict[str, Column]:
    route = F.concat(c("pickup"), F.lit(K.ROUTE_SEPARATOR), c("delivery"))
    sep = F.lit(K.COMPOSITE_SEPARATOR)
    return {
        "route": route,
        "pickup_equipment": F.concat(c("pickup"), sep, c("equipment")),
        "delivery_equipment": F.concat(c("delivery"), sep, c("equipment")),
        "route_equipment": F.concat(route, sep, c("equipment")),
    }
