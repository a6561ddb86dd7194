"""Radix selection: the order of doubles, exact quantiles, and what the plan does not do."""

import random
import struct

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from chronofit.operators import quantiles as Q


def _bits(x):
    n = struct.unpack("<q", struct.pack("<d", abs(x)))[0]
    return -n if x < 0 else n


def test_order_key_is_the_bits_of_the_double(spark):
    dice = random.Random(4)
    values = [0.0, -0.0, 1.0, -1.0, 5e-324, -5e-324, 2.0 ** -1022, 2.0 ** -1022 - 5e-324, 1.7976931348623157e308, float("inf"), float("-inf"),
              0.1, 1 / 3, 2.0 ** 52, 2.0 ** 53 + 2, 3.0, 7.999999999999999, 8.0, 8.000000000000002]
    values += [struct.unpack("<d", struct.pack("<Q", dice.getrandbits(64)))[0] for _ in range(4000)]
    values += [np.nextafter(2.0 ** e, d).item() for e in range(-1040, 1023, 7) for d in (0, np.inf)]
    values = [x for x in values if x == x]
    got = spark.createDataFrame([(x,) for x in values], "x double").select("x", Q.order_key(F.col("x")).alias("k")).collect()
    assert all(r.k == _bits(r.x) for r in got)
    assert spark.sql("SELECT CAST(NULL AS DOUBLE) AS x UNION ALL SELECT double('NaN')").select(Q.order_key(F.col("x")).alias("k")).collect() == [(None,), (None,)]


def _reference(rows, probs):
    out = {}
    for g in {g for g, _ in rows}:
        v = [x for h, x in rows if h == g and x is not None and x == x]
        if v:
            out[g] = tuple(float(np.quantile(v, p)) for p in probs)
    return out


@settings(max_examples=6, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.one_of(
    st.none(), st.floats(-1e300, 1e300), st.sampled_from([0.0, 1.0, 1.0000000000000002, -3.5]))), min_size=1, max_size=60))
def test_equals_the_sorted_definition(spark, rows):
    probs = [0.0, 0.25, 0.5, 0.99, 1.0]
    df = spark.createDataFrame(rows, "g string, x double")
    got = {r.g: tuple(r)[1:] for r in Q.exact_quantiles(df, ["g"], "x", probs, list("vwxyz")).collect()}
    want = _reference(rows, probs)
    assert got.keys() == want.keys()
    for g, w in want.items():
        assert np.allclose(got[g], w, rtol=1e-12, atol=0)


def test_values_that_differ_in_the_last_bits_only(spark):
    x = np.nextafter(1.0, 2.0) - 1.0
    df = spark.range(4001).select((F.lit(1.0) + F.lit(x) * F.col("id")).alias("x"))
    r = Q.exact_quantiles(df, [], "x", [0.5, 0.25], ["m", "q"]).first()
    assert (r.m, r.q) == (1.0 + 2000 * x, 1.0 + 1000 * x)


def test_one_call_for_many_columns_and_a_hot_group(spark):
    df = spark.range(30_000).select(F.when(F.col("id") % 3 < 2, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 101)).alias("g"),
                                    F.explode(F.array(*[F.struct(F.lit(c).alias("c"), (F.rand(i) * 10 ** i).alias("v")) for i, c in enumerate("uvw")])).alias("kv"))
    df = df.select("g", "kv.c", "kv.v")
    got = {(r.g, r.c): (r.m, r.h) for r in Q.exact_quantiles(df, ["g", "c"], "v", [0.5, 0.9], ["m", "h"]).collect()}
    want = {(r.g, r.c): (r.m, r.h) for r in df.groupBy("g", "c").agg(F.percentile("v", 0.5).alias("m"), F.percentile("v", 0.9).alias("h")).collect()}
    assert got.keys() == want.keys() and all(np.allclose(got[k], want[k], rtol=1e-12) for k in want)


def test_beyond_the_broadcast_bound(spark):
    df = spark.range(5000).select((F.col("id") % 700).alias("g"), F.rand(3).alias("v"))
    want = {r.g: r.m for r in df.groupBy("g").agg(F.percentile("v", 0.5).alias("m")).collect()}
    spark.conf.set("chronofit.broadcast_rows", "0")
    try:
        got = {r.g: r.m for r in Q.exact_quantiles(df, ["g"], "v", [0.5], ["m"]).collect()}
    finally:
        spark.conf.unset("chronofit.broadcast_rows")
    assert got.keys() == want.keys() and all(abs(got[g] - want[g]) < 1e-12 for g in want)


def test_rows_are_neither_sorted_nor_written_nor_shuffled(spark, monkeypatch):
    written = []
    real = Q.stored_table

    def spy(table, name):
        written.append((table._jdf.queryExecution().executedPlan().toString(), *real(table, name)))
        return written[-1][1:]
    monkeypatch.setattr(Q, "stored_table", spy)
    df = spark.range(50_000).select((F.col("id") % 5).alias("g"), F.rand(9).alias("v"))
    out = Q.exact_quantiles(df, ["g"], "v", [0.5], ["m"])
    assert "rangepartitioning" not in out._jdf.queryExecution().toString()
    assert 2 <= len(written) <= 3
    for plan, _, n in written:
        assert n <= 10                                   # what is kept: a row per group and wanted rank
        assert "rangepartitioning" not in plan
        lines = plan.splitlines()
        rows_at = [i for i, line in enumerate(lines) if "Range (0, 50000" in line]
        assert len(rows_at) == 1
        above = lines[:rows_at[0]][::-1]                 # from the rows upwards: counted before anything moves
        first = next(i for i, line in enumerate(above) if "Exchange hash" in line)
        assert any("partial_count" in line for line in above[:first]) and not any("SortMergeJoin" in line for line in above[:first])
