from collections import defaultdict

import pytest

from pyspark.sql import functions as F

from chronofit.llm import mixing
from chronofit.llm.common import read, uniform

from llm_helpers import SF_SMALL, SCHEMA, frame, plain, words


def expected_targets(sizes, cap=3):
    """Water filling by repeated resharing."""
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: float(i % 3 + 1) for i, s in enumerate(order)}
    total, fixed = sum(sizes.values()), {}
    while True:
        rest = [s for s in order if s not in fixed]
        left = total - sum(fixed.values())
        share = {s: left * weight[s] / sum(weight[x] for x in rest) for s in rest}
        over = [s for s in rest if share[s] > cap * sizes[s] + 1e-9]
        if not over:
            return {**fixed, **share}
        fixed.update({s: float(cap * sizes[s]) for s in over})


def check(rows, texts):
    by_source = defaultdict(list)
    for r in rows:
        by_source[r["source"]].append(r)
    sizes = {s: sum(x["size"] for x in v) for s, v in by_source.items()}
    targets = expected_targets(sizes)
    for s, v in by_source.items():
        target = targets[s]
        assert all(x["source_size"] == sizes[s] and x["target"] == pytest.approx(target) for x in v)
        assert all(0 <= x["taken"] <= 3 * x["size"] and x["taken"] == x["copies"] * x["size"] for x in v)
        # complete epochs first: copies differ by at most one
        copies = [x["copies"] for x in v if x["size"]]
        assert not copies or max(copies) - min(copies) <= 1
        assert abs(sum(x["taken"] for x in v) - target) <= max((x["size"] for x in v), default=0) + 1


def collected(df):
    # source is not a column of the result; carry it along to check by it
    return [r.asDict() | {"source": r["carry_source"]} for r in mixing.mix(df, carry=("source", "text")).collect()]


def test_targets_and_sizes(spark):
    rows = collected(read(spark, SF_SMALL, "documents"))
    check(rows, None)
    assert all(r["size"] == len(words(r["carry_text"])) for r in rows)


def test_edge_rows_and_reruns(spark):
    first, again = collected(frame(spark)), collected(frame(spark))
    check(first, None)
    key = lambda r: (str(r["id"]), str(r["carry_text"]), r["taken"])
    assert sorted(map(key, first)) == sorted(map(key, again))
    assert all(r["size"] == 0 and r["taken"] == 0 for r in first if not words(r["carry_text"]))


def test_capped_sources_and_hot_source(spark):
    rows = [(i, "w " * (i % 7 + 1), "en", "big", 0) for i in range(3000)] + [(10_000 + i, "tiny", "en", s, 4) for i, s in enumerate("xyz")]
    out = collected(spark.createDataFrame(rows, SCHEMA))
    check(out, None)
    assert {r["taken"] for r in out if r["source"] in ("x", "y", "z")} == {3}


def test_identical_rows_are_told_apart(spark):
    rows = [(1, "a b c d", "en", "s", 7)] * 40 + [(2, "a b c d", "en", "t", 7)] * 40 + [(3, "a b c d", "en", "u", 7)] * 40
    check(collected(spark.createDataFrame(rows, SCHEMA)), None)


def test_mixed_documents_repeat_rows(spark):
    df = frame(spark)
    out, plan = mixing.mixed_documents(df), mixing.mix(df)
    assert out.columns == df.columns
    assert out.count() == sum(r["copies"] for r in plan.collect())


def test_weights_prefer_better_documents(spark):
    rows = [(i, "good words here " * 5 if i % 2 else "1234 5678 #### " * 5, "en", "b" if i < 2000 else "a", 0) for i in range(6000)]
    out = collected(spark.createDataFrame(rows, SCHEMA))
    part = [r for r in out if r["source"] == "a"]
    good = sum(r["copies"] for r in part if r["id"] % 2)
    assert good > 1.3 * sum(r["copies"] for r in part if r["id"] % 2 == 0)


def test_empty_table(spark):
    assert collected(spark.createDataFrame([], SCHEMA)) == []
    assert mixing.mixed_documents(spark.createDataFrame(plain([(1, None)]), SCHEMA)).count() <= 1


def test_gap_behind_a_long_document_is_filled(spark):
    """Every source's part of an epoch is the greedy walk over its documents in key order."""
    rows = [(i, "w " * (20_000 if i == 0 else 100), "en", "a", 0) for i in range(1500)]
    rows += [(10_000 + i, "w " * (i * i % 301 + 5), "en", "b", 0) for i in range(1500)] + [(20_000, "w " * 150_000, "en", "c", 0)]
    df = spark.createDataFrame(rows, SCHEMA)
    for seed in (1, 2, 3):
        out = [r.asDict() for r in mixing.mix(df, seed=seed, carry=("source",)).collect()]
        text = F.col("text")
        keys = {r["doc_id"]: r["key"] for r in df.select("doc_id", (-F.log(uniform(F.xxhash64(
            F.lit(seed), F.col("doc_id"), F.xxhash64(text)))) / mixing.quality_weight(text)).alias("key")).collect()}
        for source in "abc":
            part = sorted((r for r in out if r["carry_source"] == source), key=lambda r: keys[r["id"]])
            left = part[0]["target"] - part[0]["epochs"] * part[0]["source_size"]
            for r in part:
                fits = r["size"] <= left
                left -= r["size"] * fits
                assert r["copies"] == r["epochs"] + fits
            if source == "a" and part[0]["epochs"] == 0:
                assert left < 100  # the short documents alone hold more than the target
