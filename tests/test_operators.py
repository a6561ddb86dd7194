"""Operators: skew-aware ranking/quantiles, selection rules, contracts, leakage safety."""

import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from chronofit import constants as K
from chronofit.operators.contracts import scenario_contract
from chronofit.operators.errors import holdout_errors
from chronofit.operators.quantiles import exact_quantiles
from chronofit.operators.ranking import rank_within_groups
from chronofit.operators.selection import leaderboard, selection_contract
from conftest import SF_SMALL


def test_hot_group_ranking_equals_window(spark):
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    order = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
             "l_discount", "l_tax", "l_linestatus"]
    fast = rank_within_groups(li, ["l_returnflag"], order, "rk")
    ref = li.withColumn("rk", F.row_number().over(Window.partitionBy("l_returnflag").orderBy(*order)))
    assert fast.exceptAll(ref).count() == 0 and ref.exceptAll(fast).count() == 0


def test_hot_group_of_identical_copies(spark):
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").select("l_returnflag")   # 3 groups of copies
    ranked = rank_within_groups(li, ["l_returnflag"], ["l_returnflag"], "rk")
    per = ranked.groupBy("l_returnflag").agg(F.count("*").alias("n"), F.min("rk").alias("lo"),
                                            F.max("rk").alias("hi"), F.count_distinct("rk").alias("d"))
    for r in per.collect():
        assert (r.lo, r.hi, r.d) == (1, r.n, r.n)


def test_hot_group_quantiles_exact(spark):
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    fast = exact_quantiles(li, ["l_returnflag"], "l_extendedprice", [0.05, 0.5, 0.99], ["a", "b", "c"])
    ref = li.groupBy("l_returnflag").agg(*[F.percentile("l_extendedprice", p).alias(n)
                                           for p, n in [(0.05, "a"), (0.5, "b"), (0.99, "c")]])
    f = {r.l_returnflag: r for r in fast.collect()}
    for r in ref.collect():
        for n in "abc":
            assert abs(f[r.l_returnflag][n] - r[n]) < 1e-9


def test_ranking_keeps_payload_and_counts_in_64_bits(spark):
    rows = [("g" if i % 3 else None, float("nan") if i % 5 == 0 else None if i % 5 == 1 else float(i), i) for i in range(60)]
    df = spark.createDataFrame(rows, "g string, x double, i int")
    out = rank_within_groups(df, ["g"], ["i"], "rk")
    assert out.schema["rk"].dataType.simpleString() == "bigint"
    ref = df.withColumn("rk", F.row_number().over(Window.partitionBy("g").orderBy("i")).cast("bigint"))
    assert sorted(map(str, out.collect())) == sorted(map(str, ref.select(out.columns).collect()))
    assert "SinglePartition" not in out._jdf.queryExecution().toString()


def test_quantiles_ignore_missing_and_empty(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("a", float("nan")), ("a", 4.0), (None, 2.0), ("c", None)], "g string, x double")
    got = {r.g: (r.m, r.hi) for r in exact_quantiles(df, ["g"], "x", [0.5, 1.0], ["m", "hi"]).collect()}
    assert got == {"a": (2.5, 4.0), None: (2.0, 2.0)}
    assert exact_quantiles(df.where("g = 'zz'"), [], "x", [0.5], ["m"]).count() == 0


def _long(spark, rows):
    return spark.createDataFrame(rows, "model string, model_family string, eligible boolean, actual double, "
                                       "predicted double")


def test_tie_broken_by_name(spark):
    rows = [("b", "A", True, 10.0, 11.0), ("a", "A", True, 10.0, 9.0), ("base", K.BASELINE_FAMILY, False, 10.0, 10.0)]
    board = leaderboard(_long(spark, rows))
    sel = [r.model for r in board.where("selected").collect()]
    assert sel == ["a"]      # equal MAE: name order; the better ineligible baseline is never selected
    checks = {r.check: r.violations for r in selection_contract(board, baselines=["base"]).collect()}
    assert all(v == 0 for v in checks.values()), checks


def test_selection_contract_catches_lies(spark):
    board = leaderboard(_long(spark, [("a", "A", True, 10.0, 11.0), ("b", "A", True, 10.0, 15.0)]))
    lied = board.withColumn("selected", F.col("model") == "b")
    checks = {r.check: r.violations for r in selection_contract(lied).collect()}
    assert checks["C19_not_min"] == 1


def test_scenario_contract_order(spark):
    days = [(dt.date(2025, 12, d),) for d in range(1, 32)]
    grid = (spark.createDataFrame(days, "date date")
            .select(F.lit("Lexington").alias("pickup"), F.lit("Fort Wayne").alias("delivery"),
                    F.lit(360.0).alias("distance"), F.lit("Dry Van").alias("equipment"),
                    F.lit(32000.0).alias("weight"), "date", F.lit(800.0).alias(K.PREDICTION)))
    expected = {"pickup": "Lexington", "delivery": "Fort Wayne", "equipment": "Dry Van", "distance": 360.0,
                "weight": 32000.0, "month": "2025-12-01"}
    shuffled = grid.withColumn("ordinal", 32 - F.dayofmonth("date"))      # reversed file order
    strict = {r.check: r.violations for r in scenario_contract(shuffled, expected, ordered=True).collect()}
    loose = {r.check: r.violations for r in scenario_contract(shuffled.drop("ordinal"), expected).collect()}
    assert strict["C10_dates_out_of_order"] > 0
    assert all(v == 0 for v in loose.values()), loose
    missing = {r.check: r.violations for r in
               scenario_contract(grid.where(F.dayofmonth("date") != 5), expected).collect()}
    assert missing["C14_missing_days"] == 1


def test_route_status_thresholds(spark):
    train_rows = [("p", "q")] * 10 + [("p", "r")] * 9 + [("p", "s")]
    train = spark.createDataFrame(train_rows, "pickup string, delivery string")
    hold = spark.createDataFrame(
        [(f"id{i}", dt.date(2025, 1, 1), 1.0, 1.0, 100.0, "Dry Van", "p", d) for i, d in enumerate("qrst")],
        f"load_id string, date date, {K.TARGET} double, predicted double, distance double, equipment string, "
        "pickup string, delivery string")
    out = {r.load_id: r.route_status for r in holdout_errors(hold, train).collect()}
    assert out == {"id0": "Common (>=10)", "id1": "Rare (<10)", "id2": "Rare (<10)", "id3": "Unseen"}


def test_state_is_leakage_safe(spark):
    from chronofit.operators.features import fit
    from chronofit.plans.context import context
    c = context(spark, SF_SMALL)
    a = fit(c.training, checkpoint=False)
    # other holdout rows change neither the training part nor its state
    cut = F.col("date") >= F.lit(c.outer.cutoff)
    odd = c.development.withColumn("weight", F.when(cut, F.lit(1e9)).otherwise(F.col("weight"))).withColumn(
        "equipment", F.when(cut, F.lit("Other")).otherwise(F.col("equipment")))
    b = fit(c.outer.training(odd), checkpoint=False)
    assert a.reference_date == b.reference_date and a.rows == b.rows and a.medians == b.medians
    assert a.counts.exceptAll(b.counts).count() == 0 and fit(odd, checkpoint=False).medians != a.medians


def test_missing_predictions_never_win(spark):
    rows = [("partial", "A", True, 10.0, 10.0), ("partial", "A", True, 10.0, None), ("whole", "A", True, 10.0, 10.5), ("whole", "A", True, 10.0, 9.5),
            ("nan", "A", True, 10.0, float("nan")), ("nan", "A", True, 10.0, 10.0)]
    board = {r.model: r for r in leaderboard(_long(spark, rows)).collect()}
    assert board["whole"].selected and not board["partial"].selected and not board["nan"].selected
    assert board["partial"].mae is None and board["partial"].smape is None and board["nan"].r2 is None


def test_scenario_label_and_reconciliation(spark):
    from chronofit.operators.selection import reconcile_summary
    board = leaderboard(_long(spark, [("a", "A", True, 10.0, 11.0), ("b", "A", True, 10.0, 15.0)]), label="scenario").withColumn(
        "feature_set", F.lit("fs"))
    assert board.where("selected").first().signature.startswith("SCENARIO|model=a")
    summary = spark.createDataFrame([(("a", "A", "fs", 1.0),)], "selection struct<model string, family string, feature_set string, mae double>")

    def failing(b):
        return {r.check for r in reconcile_summary(b, summary, {"a": "A", "b": "A"}, []).collect() if r.violations}
    assert failing(board) == set()
    assert "C20_not_one_selected" in failing(board.withColumn("selected", F.lit(False)))
    assert "C20_selected_mae_mismatch" in failing(board.withColumn("mae", F.lit(None).cast("double")))


def test_csv_columns_by_name_and_json_documents(spark, tmp_path):
    import pytest
    from chronofit.sources.csv_io import read_text_csv
    from chronofit.sources.sinks import write_document
    (tmp_path / "x.csv").write_text("distance,load_id,date\n12.5,007,2024-01-02\nNA,008,\n")
    rows = read_text_csv(spark, str(tmp_path / "x.csv"), ["load_id", "date", "distance"]).collect()
    assert [tuple(r) for r in rows] == [("007", "2024-01-02", "12.5"), ("008", None, None)]
    with pytest.raises(ValueError):
        read_text_csv(spark, str(tmp_path / "x.csv"), ["load_id", "weight"])
    doc = spark.sql("SELECT named_struct('z', 1, 'a', CAST(NULL AS INT)) AS s, array(named_struct('y', 2, 'b', 3)) AS l, CAST(NULL AS STRING) AS e")
    write_document(doc, str(tmp_path / "doc"))
    assert spark.read.text(str(tmp_path / "doc")).first()[0] == '{"e":null,"l":[{"b":3,"y":2}],"s":{"a":null,"z":1}}'


def test_scenario_contract_sees_missing_pickup(spark):
    days = [(dt.date(2024, 2, d), None, "Y", "Van", 100.0, 10.0, 5.0) for d in range(1, 30)]
    columns = K.SCENARIO_COLUMNS + [K.PREDICTION]
    kinds = {"date": "date", "pickup": "string", "delivery": "string", "equipment": "string", "distance": "double", "weight": "double", K.PREDICTION: "double"}
    values = dict(zip(("date", "pickup", "delivery", "equipment", "distance", "weight", K.PREDICTION), zip(*days)))
    df = spark.createDataFrame([tuple(values[c][i] for c in columns if c in values) for i in range(29)],
                               ", ".join(f"`{c}` {kinds[c]}" for c in columns if c in values))
    expected = {"pickup": "X", "delivery": "Y", "equipment": "Van", "distance": 100.0, "weight": 10.0, "month": "2024-02-01"}
    checks = {r.check: r.violations for r in scenario_contract(df, expected).collect()}
    assert checks["C10_fixed_inputs_changed"] == 29
