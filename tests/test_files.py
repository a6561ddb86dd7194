"""Grids, malformed records, result manifests, importance without copies."""

import pytest
from pyspark.sql import functions as F

from chronofit.operators.grid import missing_ranges, runs
from chronofit.sources.csv_io import read_csv_records
from chronofit.sources.sinks import write_results


@pytest.mark.parametrize("found, want", [
    ([1, 2, 4, 4, None, 9], [(3, 3, 1), (5, 8, 4), (10, 12, 3)]), ([], [(1, 12, 12)]), (range(-5, 40), []), ([12], [(1, 11, 11)]), ([1], [(2, 12, 11)])])
def test_gaps_are_islands(spark, found, want):
    df = spark.createDataFrame([(i,) for i in found], "n bigint").repartition(3)
    assert sorted(map(tuple, missing_ranges(df, "n", 1, 12).collect())) == want


def test_a_missing_million_is_one_row(spark):
    df = spark.range(1, 1_200_001).where((F.col("id") <= 100_000) | (F.col("id") > 1_100_000))
    assert list(map(tuple, missing_ranges(df, "id", 1, 1_200_000).collect())) == [(100_001, 1_100_000, 1_000_000)]
    assert sorted(map(tuple, runs(df, "id").collect())) == [(1, 100_000), (1_100_001, 1_200_000)]


def test_malformed_lines_are_set_apart(spark, tmp_path):
    (tmp_path / "x.csv").write_text('a,b,c\n1,NA,3\n1,2\n"x, y",5,6\n1,2,3,4\n')
    records, rejects = read_csv_records(spark, str(tmp_path / "x.csv"), ["a", "b", "c"])
    assert sorted(map(tuple, records.collect()), key=str) == [("1", None, "3"), ("x, y", "5", "6")]
    assert sorted(r.line for r in rejects.collect()) == ["1,2", "1,2,3,4"]


def test_manifest_finds_a_changed_table(spark, tmp_path, monkeypatch):
    from chronofit.sources import sinks
    a = spark.createDataFrame([(" x ", 1.5, None), ("", None, 2), ('q"u,o\nte', -0.0, 3)], "s string, d double, n int")
    out = {r.table: (r.rows, r.differs) for r in write_results({"a": a, "empty": a.where("n > 9")}, str(tmp_path)).collect()}
    assert out["empty"] == (0, False)
    assert out["a"][0] == 3
    real = sinks.write_table
    monkeypatch.setattr(sinks, "write_table", lambda df, path, fmt="parquet": real(df.limit(1) if fmt == "csv" else df, path, fmt))
    assert {r.table: r.differs for r in write_results({"a": a}, str(tmp_path / "b")).collect()} == {"a": True}


def test_importance_moves_one_feature_at_a_time(spark, monkeypatch):
    from chronofit.operators import importance as I
    rows = spark.range(200).select(F.col("id").cast("double").alias("x"), (F.col("id") * 0 + 5).cast("double").alias("y"), F.lit(1.0).alias("distance"),
                                   F.col("id").cast("double").alias("posted_rate"))
    seen = []

    def score(model, feats, out):
        seen.append(feats)
        return feats.withColumn(out, F.col("x") + 0 * F.col("y"))
    monkeypatch.setattr(I, "predict", score)

    class Model:
        features = ["x", "y"]
    got = {r.feature: r for r in I.permutation_importance(Model, rows).collect()}
    assert got["y"].importance == 0 and got["x"].baseline_sample_mae == 0 and got["x"].importance > 0
    moved = seen[0].where("__feature = 'x'").collect()
    assert sorted(r.x for r in moved) == [float(i) for i in range(200)] and all(r.x != r.posted_rate for r in moved)
    plan = seen[0]._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate explode") < plan.index("Join Inner")     # copies are made behind the one join
