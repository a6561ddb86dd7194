"""What the figures at size rest on: one evaluation per row, one task per hot group nowhere, balanced files."""

import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from chronofit.functions.clean import normalise_category
from chronofit.operators import quantiles as Q
from chronofit.operators import ranking as R
from chronofit.sources import fixture


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_methods_stay_small_enough_to_be_compiled(spark):
    from chronofit.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(spark)
    assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"


def test_a_quantile_key_and_a_clean_name_are_computed_once(spark, monkeypatch):
    plans = []
    real = Q.stored_table
    monkeypatch.setattr(Q, "stored_table", lambda t, n: (plans.append(_plan(t)), real(t, n))[1])
    Q.exact_quantiles(spark.range(2000).select((F.col("id") % 3).alias("g"), F.rand(5).alias("v")), ["g"], "v", [0.5], ["m"]).collect()
    assert plans and all(p.count("LOG2(") == 1 for p in plans)
    names = spark.createDataFrame([("  new   york",), (" \t",), ("",), (None,), ("o'hare st.louis 3m",)], "c string")
    out = names.select(normalise_category("c").alias("c"))
    assert _plan(out).count("\\s+") == 1
    assert [r.c for r in out.collect()] == ["New York", "Unknown", "Unknown", "Unknown", "O'Hare St.Louis 3M"]


def test_large_and_small_groups_are_numbered_alike(spark):
    df = spark.range(4000).select(F.when(F.col("id") % 4 > 0, F.lit("hot")).when(F.col("id") % 8 > 0, F.concat(F.lit("g"), F.col("id") % 100)).alias("g"), "id")
    want = df.withColumn("rk", F.row_number().over(Window.partitionBy("g").orderBy("id")).cast("long")).withColumn(
        "n", F.count(F.lit(1)).over(Window.partitionBy("g")))
    for limit in ("1000000", "100", "0"):
        spark.conf.set(R.HOT_ROWS_KEY, limit)
        try:
            got = R.rank_within_groups(df, ["g"], ["id"], "rk", size_col="n")
            assert "rangepartitioning" not in _plan(got)     # rows of hot groups were written
            if limit == "1000000":                           # one shuffle by the groups
                assert _plan(got).count("Exchange") == 1
            assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
        finally:
            spark.conf.unset(R.HOT_ROWS_KEY)


def _tables(spark, folder, lines, orders):
    stamp = dt.datetime(1999, 5, 1)
    rows = [(o, p, 1, n, 3.0, 100.0, 0.1, 0.02, "A", "F", stamp + dt.timedelta(days=d)) for o, p, n, d in lines]
    spark.createDataFrame(rows, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
                                "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp").write.parquet(f"{folder}/lineitem.parquet")
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long").write.parquet(f"{folder}/orders.parquet")
    for name, schema, values in [("customer", "c_custkey long, c_nationkey int", [(1, 2), (2, 3)]), ("supplier", "s_suppkey long, s_nationkey int", [(1, 4)]),
                                 ("part", "p_partkey long, p_size int", [(1, 5), (2, 6)])]:
        spark.createDataFrame(values, schema).write.parquet(f"{folder}/{name}.parquet")


def test_repeated_lines_and_orders_get_numbers_of_their_own(spark, tmp_path):
    _tables(spark, str(tmp_path), [(7, 1, 1, 0), (7, 1, 1, 3), (7, 2, 2, 0), (8, 1, 1, 0), (None, 1, 1, 0), (9, 1, 1, 0)], [(7, 1), (7, 2), (8, 1), (None, 1), (9, 99)])
    got = sorted((r.load_id, r.date.day) for r in fixture.build_loads(spark, str(tmp_path)).collect())
    assert got == [("7-1-1-1-1", 1), ("7-1-1-1-2", 1), ("7-1-1-1-3", 4), ("7-1-1-1-4", 4), ("7-2-2-1-1", 1), ("7-2-2-1-2", 1), ("8-1-1-1-1", 1)]


def test_a_short_window_of_dates_is_many_files(spark, tmp_path, monkeypatch):
    lines = [(i, 1 + i % 2, 1, i % 3) for i in range(300)] + [(1000, 1, 1, 0)]
    _tables(spark, str(tmp_path / "in"), lines, [(i, 1 + i % 2) for i in range(300)] + [(1000, 1)])
    monkeypatch.setattr(fixture, "FILE_ROWS", 20, raising=False)
    out = fixture.materialize_loads(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    per_file = out.groupBy(F.input_file_name().alias("f")).agg(F.count(F.lit(1)).alias("n"), F.min("date").alias("a"), F.max("date").alias("b")).collect()
    assert sum(r.n for r in per_file) == 301 and len(per_file) >= 14 and max(r.n for r in per_file) <= 60
    assert len([r for r in per_file if r.a <= dt.date(1999, 5, 2) <= r.b]) >= 4
    assert out.exceptAll(fixture.build_loads(spark, str(tmp_path / "in"))).count() == 0


def test_names_are_normalised_once_per_distinct_value(spark):
    from chronofit.operators.baselines import _with_group, group_median_rpm
    rows = spark.createDataFrame([(" dry  van", 10.0, 30.0), ("Dry Van", 10.0, 10.0), (None, 10.0, 50.0), ("unknown", 10.0, 70.0)],
                                 "equipment string, distance double, posted_rate double")
    assert sorted(r["__g"] for r in _with_group(rows, "equipment").collect()) == ["Dry Van", "Dry Van", "Unknown", "Unknown"]
    out = group_median_rpm(rows, rows)
    assert sorted(r.predicted for r in out.collect()) == [20.0, 20.0, 60.0, 60.0]
    assert "regexp_replace" not in out._jdf.queryExecution().optimizedPlan().toString()


def test_scenario_rows_are_met_by_their_raw_names(spark):
    from chronofit.sources import fixture
    from conftest import SF_SMALL
    plan = fixture.scenario_inputs(spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_replace" not in plan


def test_the_files_of_the_fixture_are_dealt_before_its_columns_are_made(spark, tmp_path, monkeypatch):
    _tables(spark, str(tmp_path / "in"), [(i, 1 + i % 2, 1, i % 3) for i in range(30)], [(i, 1 + i % 2) for i in range(30)])
    seen, real = [], fixture._loads_of
    monkeypatch.setattr(fixture, "_loads_of", lambda rows: (seen.append(rows), real(rows))[1])
    out = fixture.materialize_loads(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    plan = seen[0]._jdf.queryExecution().optimizedPlan().toString()
    assert len(seen) == 1 and "RepartitionByExpression" in plan and "concat" not in plan
    assert out.count() == 30 and out.exceptAll(fixture.build_loads(spark, str(tmp_path / "in"))).count() == 0


def test_the_numeric_summary_makes_no_scenario(spark, monkeypatch):
    from chronofit.plans import q_relational
    from conftest import SF_SMALL

    def none(*_):
        raise AssertionError("the scenario is no part of the summary")
    monkeypatch.setattr(fixture, "scenario_inputs", none)
    assert q_relational.q_numeric_summary(spark, SF_SMALL).count() == 8


def test_rows_of_no_holdout_are_left_out_before_their_scopes_are_listed(spark, tmp_path):
    from chronofit.operators.baselines import scoped_baselines
    from chronofit.operators.split import Scope
    d = dt.date
    scopes = [Scope("a", d(2000, 1, 3), d(2000, 1, 3), d(2000, 1, 4)), Scope("b", d(2000, 1, 4), d(2000, 1, 4), d(2000, 1, 5))]
    rows = [(i, None if i == 0 else d(2000, 1, i), " dry  van" if i % 2 else None, 10.0, 10.0 * i if i else None) for i in range(8)]
    spark.createDataFrame(rows, "id int, date date, equipment string, distance double, posted_rate double").write.parquet(str(tmp_path / "in"))
    out = scoped_baselines(spark.read.parquet(str(tmp_path / "in")), scopes)
    got = sorted((r.scope, r.id, r.global_median, r.group_median) for r in out.collect())
    assert got == [("a", 3, 15.0, 10.0), ("a", 4, 15.0, 20.0), ("b", 4, 20.0, 20.0), ("b", 5, 20.0, 20.0)]
    scan = next(line for line in _plan(out).splitlines() if "FileScan parquet" in line and "date" in line)
    assert "PushedFilters: [Or(" in scan
