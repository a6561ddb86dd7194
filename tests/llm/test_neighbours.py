"""Learned partitions against all-pairs comparison."""

import math

import numpy as np
import pytest

from llm_helpers import SF_SMALL

from chronofit.llm import learned_partitions as L
from chronofit.llm import queries

SCHEMA = "vec_id bigint, embedding array<float>, n int, part int, score double"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2, 3.0) for i, v in rows], SCHEMA)


def usable(rows):
    rows = [(i, tuple(map(lambda x: float(np.float32(x)), v))) for i, v in rows
            if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    sizes = sorted((-sum(len(w) == n for _, w in set(rows)), n) for n in {len(v) for _, v in rows})
    return sorted({(i, v) for i, v in rows if len(v) == sizes[0][1]}) if rows else []


def brute(rows, every=20, top=20):
    rows, out = usable(rows), []
    for q, v in rows:
        if q % every == 0:
            near = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in rows if i != q)[:top]
            out += [(q, n, i, -s) for n, (s, i) in enumerate(near, 1)]
    return sorted(out)


def result(df):
    return sorted(tuple(r) for r in df.select("query_id", "rank", "vec_id", "score").collect())


def close(got, want):
    assert [r[:3] for r in got] == [r[:3] for r in want]
    assert all(math.isclose(a[3], b[3], rel_tol=1e-12, abs_tol=1e-300) for a, b in zip(got, want))


def clustered(seed, n, d=12, centres=9, spread=0.35):
    dice = np.random.default_rng(seed)
    middle = dice.standard_normal((centres, d))
    x = middle[dice.integers(0, centres, n)] + spread * dice.standard_normal((n, d))
    return (x * dice.uniform(0.7, 1.3, (n, 1))).astype(np.float32)


def test_edge_rows_ties_and_copies(spark):
    x = clustered(1, 60)
    rows = [(i, x[i].tolist()) for i in range(60)]
    rows += [(100 + i, x[3].tolist()) for i in range(45)]  # copies, three of them queries
    rows += [(200, None), (220, []), (240, [0.0] * 12), (260, [1.0, None] + [0.0] * 10), (280, [float("nan")] * 12),
             (300, [float("inf")] + [0.0] * 11), (320, [1.0, 2.0]), (None, x[4].tolist()), (20, x[20].tolist()), (-40, (-x[5]).tolist()),
             (340, [1e-30] * 12), (360, [1e30] * 12)]
    close(result(L.search(table(spark, rows))), brute(rows))


def test_few_candidates_and_empty_table(spark):
    rows = [(i, [float(i + 1), 1.0]) for i in range(0, 60, 20)]
    close(result(L.search(table(spark, rows))), brute(rows))
    assert L.search(table(spark, [])).collect() == []
    assert L.search(table(spark, [(0, [1.0])])).collect() == []
    assert L.search(table(spark, [(0, None)])).collect() == []


def test_parts_are_balanced_and_follow_the_graph():
    x = clustered(2, 640, centres=8, spread=0.05)
    unit = L._directions(x).astype(np.float32)
    near = L.nearest_in(unit, 10)
    part = L.balanced_parts(near, 8)
    assert np.bincount(part).min() >= 640 // 8 - 3 and part.max() == 7
    assert (part[near] == part[:, None]).mean() > 0.75


def test_router_finds_parts_of_new_vectors():
    x = clustered(3, 3000)
    router = L.fit_router(x[:2000], 8)
    again = L.Router.load(router.save())
    assert (again.place(x[2000:]) == router.place(x[2000:])).all()
    near = L.nearest_in(x, 20)[2000:]
    part, p = router.place(x), router.route(x[2000:])
    assert np.allclose(p.sum(axis=1), 1, atol=1e-5)
    order = np.argsort(-p, axis=1)[:, :4]
    assert np.mean([np.isin(part[n], o).mean() for n, o in zip(near, order)]) > 0.9


@pytest.mark.parametrize("blocks", [(16_384, 4096), (70, 9)])
def test_recall_with_many_parts_and_blocks(spark, monkeypatch, blocks):
    x = clustered(4, 2500)
    x[1000:1400] = x[1]  # a crowded part
    rows = [(i, v) for i, v in enumerate(x.tolist())]
    monkeypatch.setattr(L, "PART_ROWS", 256)
    monkeypatch.setattr(L, "CLASS_BLOCK", blocks[0])
    monkeypatch.setattr(L, "QUERY_BLOCK", blocks[1])
    got, want = result(L.search(table(spark, rows))), brute(rows)
    assert len(got) == len(want)
    assert len({r[::2] for r in got} & {r[::2] for r in want}) / len(want) > 0.95
    exact = {r[:1] + r[2:3]: r[3] for r in want}
    assert all(math.isclose(exact[q, i], s, rel_tol=1e-9) for q, _, i, s in got if (q, i) in exact)


def test_queries_that_found_too_few_go_everywhere(spark, monkeypatch):
    x = clustered(5, 1200)
    monkeypatch.setattr(L, "PART_ROWS", 64)
    rows = list(enumerate(x.tolist()))
    monkeypatch.setattr(L, "TOP", 20)
    got = result(L.search(table(spark, rows), top=200, mass=0.0, least=1))
    per = {}
    for q, rank, _, _ in got:
        per.setdefault(q, []).append(rank)
    assert len(per) == 60 and all(sorted(r) == list(range(1, 201)) for r in per.values())


def test_query_on_whole_table(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").collect()]
    close(result(queries.op13_nearest_neighbours(spark, SF_SMALL)), brute(rows))
