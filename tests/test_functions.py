"""Hand-made edge rows for the traps that change answers (FIXTURES.md §4)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from chronofit import constants as K
from chronofit.functions.clean import base_clean, normalise_category, parse_boolean, to_date, to_double
from chronofit.functions.features import date_features, distance_band, haversine
from chronofit.functions.metrics import regression_aggs
from chronofit.operators.quantiles import exact_quantiles


def test_title_case_matches_python(spark):
    cases = ["  o'hare  ", "fort-wayne", "FORT\t wayne", "st.louis", "", None, "dry van", "3m co", "évry"]
    want = ["O'Hare", "Fort-Wayne", "Fort Wayne", "St.Louis", "Unknown", "Unknown", "Dry Van", "3M Co", "Évry"]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cases)], "i int, c string")
    got = [r.n for r in df.select("i", normalise_category("c").alias("n")).orderBy("i").collect()]
    assert got == want


def test_numeric_text_coercion(spark):
    cases = ["abc", " 12 ", "1e3", "inf", "NaN", "1_000", "", "-0", "+5", "0x1A", "1d", "5f", None]
    want = [None, 12.0, 1000.0, float("inf"), None, None, None, -0.0, 5.0, None, None, None, None]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cases)], "i int, c string")
    got = [r.v for r in df.select("i", to_double("c", df.schema["c"].dataType).alias("v")).orderBy("i").collect()]
    assert got == want


def test_distance_bands(spark):
    vals = [70.0, 250.0, 250.1, 800.0, 1600.0, 1700.0, None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, d double")
    got = [r.b for r in df.select("i", distance_band(F.col("d")).alias("b")).orderBy("i").collect()]
    assert got == ["Short", "Short", "Medium", "Medium", "Long", "Very Long", "Unknown"]


def test_weight_flags_and_ranges(spark):
    rows = [("a", "2025-01-01", -5.0, 90.0, -180.0), ("b", "2025-01-01", 0.0, 90.1, -181.0),
            ("c", "2025-01-01", None, 0.0, 0.0), ("d", "2025-01-01", 7.0, 0.0, 0.0)]
    df = spark.createDataFrame(rows, "load_id string, date string, weight double, pickup_lat double, pickup_lon double")
    out = {r.load_id: r for r in base_clean(df).collect()}
    assert [out[k].weight for k in "abcd"] == [None, None, None, 7.0]
    assert [out[k].weight_missing for k in "abcd"] == [0, 0, 1, 0]
    assert [out[k].weight_sign_corrected for k in "abcd"] == [1, 0, 0, 0]
    assert out["a"].pickup_lat == 90.0 and out["b"].pickup_lat is None
    assert out["a"].pickup_lon == -180.0 and out["b"].pickup_lon is None
    # absent columns are synthesised: categoricals Unknown, numerics NULL
    assert out["a"].equipment == "Unknown" and out["a"].market_index is None


def test_iso_dates_only(spark):
    df = spark.createDataFrame([("2025-13-01",), ("2025/12/01",), ("2024-12-30",)], "d string")
    got = [r.x for r in df.select(to_date("d", df.schema["d"].dataType).alias("x")).collect()]
    assert got == [None, None, dt.date(2024, 12, 30)]


def test_calendar_features(spark):
    df = spark.createDataFrame([(dt.date(2024, 12, 30),), (dt.date(2025, 11, 25),), (dt.date(2025, 11, 24),)], "d date")
    f = date_features(F.col("d"), dt.date(2024, 12, 1))
    got = df.select(f["week_of_year"].alias("w"), f["day_of_week"].alias("dow"),
                    f["near_thanksgiving"].alias("nt"), f["days_since_start"].alias("ds")).collect()
    assert (got[0].w, got[0].dow, got[0].ds) == (1, 0, 29)
    assert (got[1].nt, got[2].nt) == (1, 0)


def test_haversine_ratio_null_safe(spark):
    from chronofit.functions.features import at_least
    df = spark.createDataFrame([(None, 10.0), (0.5, 10.0)], "h double, d double")
    got = [r.r for r in df.select((F.col("d") / at_least(F.col("h"), 1.0)).alias("r")).collect()]
    assert got == [None, 10.0]
    z = spark.createDataFrame([(40.0, -80.0, 40.0, -80.0)], "a double, b double, c double, e double")
    assert z.select(haversine(F.col("a"), F.col("b"), F.col("c"), F.col("e")).alias("h")).first().h == 0.0


def test_metric_edge_cases(spark):
    zero = spark.createDataFrame([(0.0, 0.0)], "actual double, predicted double")
    r = zero.agg(*regression_aggs()).first()
    assert r.smape == 0.0 and r.mae == 0.0
    perfect = spark.createDataFrame([(5.0, 5.0), (5.0, 5.0)], "actual double, predicted double")
    imperfect = spark.createDataFrame([(5.0, 4.0), (5.0, 6.0)], "actual double, predicted double")
    assert perfect.agg(*regression_aggs()).first().r2 == 1.0
    assert imperfect.agg(*regression_aggs()).first().r2 == 0.0


def test_quantiles_std_skew(spark):
    from chronofit.operators.audit import target_distribution
    vals = [1.0, 2.0, 3.5, 10.0, 7.0, 7.5]
    df = spark.createDataFrame([(v,) for v in vals], f"{K.TARGET} double")
    q = exact_quantiles(df, [], K.TARGET, [0.95, 0.5], ["p95", "median"]).first()
    assert q.p95 == pytest.approx(9.375) and q.median == pytest.approx(5.25)
    t = target_distribution(df).first()
    assert t.std == pytest.approx(3.530817, abs=1e-6) and t.skew == pytest.approx(0.157134, abs=1e-6)


def test_boolean_parsing(spark):
    df = spark.createDataFrame([("True",), (" y ",), ("0",), ("No",), ("maybe",)], "b string")
    assert [r.v for r in df.select(parse_boolean("b").alias("v")).collect()] == [True, True, False, False, None]


def test_csv_text_reader_keeps_ids_and_reads_na(spark, tmp_path):
    from chronofit.sources.csv_io import read_text_csv, typed_loads
    path = tmp_path / "loads.csv"
    path.write_text("load_id,distance,date,pickup\n"
                    "007,12.5,2025-01-02,a\n"
                    "008,N/A,2025-13-01,NA\n"
                    "009,1e3,2025-01-03,\n")
    typed = typed_loads(read_text_csv(spark, str(path), ["load_id", "distance", "date", "pickup"]))
    rows = {r.load_id: r for r in typed.collect()}
    assert set(rows) == {"007", "008", "009"}                  # leading zeros kept
    assert rows["007"].distance == 12.5 and rows["009"].distance == 1000.0
    assert rows["008"].distance is None and rows["008"].date is None and rows["008"].pickup is None
    assert rows["009"].pickup is None
