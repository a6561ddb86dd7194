import numpy as np
import pytest

from chronofit.llm import near_dedup
from chronofit.llm.common import read
from chronofit.llm.graph import components
from chronofit.llm.textarrays import mix64

from llm_helpers import SF_SMALL, LOWER, SCHEMA, Groups, frame, long_text, plain, words


def shingles(text, k):
    w = words((text or "").translate(LOWER))
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def expected(rows, k, percent):
    """Component of each distinct text by comparing all pairs."""
    texts = sorted({t or "" for _, t in rows})
    sets, groups = {t: shingles(t, k) for t in texts}, Groups()
    for i, a in enumerate(texts):
        for b in texts[:i]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= percent * len(sets[a] | sets[b]):
                groups.link(a, b)
    least = {}
    for i, t in rows:
        if i is not None and sets[t or ""]:
            r = groups.root(t or "")
            least[r] = min(least.get(r, i), i)
    return [(i, len(sets[t or ""]), i if not sets[t or ""] else least.get(groups.root(t or ""))) for i, t in rows]


def check(spark, rows, k=3, percent=85, clashes=False):
    df = frame(spark, plain(rows), clashes)
    got = [(r["id"], r["n_shingles"], r["component_id"]) for r in near_dedup.group_near_duplicates(df, k=k, percent=percent).collect()]
    assert sorted(got, key=str) == sorted(expected(rows, k, percent), key=str)


def test_matches_all_pairs_on_documents(spark):
    rows = [(r["doc_id"], r["text"]) for r in read(spark, SF_SMALL, "documents", "doc_id", "text").collect()]
    check(spark, rows)


def edited(base, places):
    w = base.split()
    for p in places:
        w[p % len(w)] = f"edit{p}"
    return " ".join(w)


def test_large_group_of_near_copies(spark):
    """Copies with few to many edits: some link to the base, some only to each other, some to none."""
    rng, base = np.random.default_rng(5), long_text(8, 150)
    rows = [(i, edited(base, rng.integers(0, 150, rng.integers(0, 9)).tolist())) for i in range(300)]
    check(spark, rows)


def test_chain_links_are_found_without_the_hub(spark):
    base = long_text(9, 200)
    chain = [base]
    for step in range(12):
        chain.append(edited(chain[-1], [step * 16, step * 16 + 5]))
    check(spark, [(100 - i, t) for i, t in enumerate(chain)])


def test_edge_rows(spark):
    df = frame(spark)
    rows = [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]
    check(spark, rows, clashes=True)
    check(spark, rows, k=5, percent=80)
    check(spark, [])


def test_keep_one_of_each(spark):
    df = frame(spark)
    out = near_dedup.keep_one_of_each(df)
    rows = [(r["doc_id"], r["text"]) for r in out.collect()]
    assert out.columns == df.columns
    # 1, 2, 3 are one group, the repeated row 12 stays once, rows without words all stay
    assert sorted(str(i) for i, _ in rows) == sorted(map(str, [1, 4, 5, 6, 7, 8, 9, 10, 11, 12, None, 13]))


def reference_superminhash(elements, m):
    """The algorithm element by element, with the operator's random draws."""
    h = np.full(m, np.inf)
    for e in elements:
        p = list(range(m))
        for j in range(m):
            draw = mix64(np.array([e], np.uint64) + near_dedup._STEPS[j:j + 1])
            r = float((draw >> np.uint64(11)).astype(np.float64)[0]) * 2.0 ** -53
            k = j + int((int(mix64(draw)[0]) >> 32) * (m - j) >> 32)
            p[j], p[k] = p[k], p[j]
            h[p[j]] = min(h[p[j]], r + j)
    return h


@pytest.mark.parametrize("n", [1, 3, 40, 700])
def test_superminhash_is_the_sequential_one(n):
    elements = mix64(np.arange(n, dtype=np.uint64) + np.uint64(17))
    assert np.allclose(near_dedup.superminhash(elements, 16), reference_superminhash(elements, 16))


def test_superminhash_estimates_jaccard():
    rng = np.random.default_rng(3)
    errors = []
    for _ in range(60):
        pool = mix64(rng.integers(0, 1 << 60, 400).astype(np.uint64))
        a, b = pool[:300], pool[100:]
        errors.append((near_dedup.superminhash(a) == near_dedup.superminhash(b)).mean() - 0.5)
    assert abs(np.mean(errors)) < 0.03 and np.std(errors) < 0.08


def test_components(spark):
    rng, groups = np.random.default_rng(4), Groups()
    links = [(int(a), int(b)) for a, b in rng.integers(0, 400, (300, 2))] + [(i, i + 1) for i in range(1000, 1060)] + [(2000, i) for i in range(2001, 2300)]
    for a, b in links:
        if a != b:
            groups.link(a, b)
    df = spark.createDataFrame(links, "a bigint, b bigint").repartition(7)
    got = {r["node"]: r["root"] for r in components(df).collect()}
    assert got == {x: groups.root(x) for x in groups.parent}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0
    assert SCHEMA
