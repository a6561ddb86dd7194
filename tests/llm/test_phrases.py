"""Phrase mining against counting every phrase in plain Python."""

import collections
import random
import re

from llm_helpers import LOWER, SF_SMALL, edge_rows, frame

from chronofit.llm import phrase_mining as P
from chronofit.llm import queries

BREAK, WORD = re.compile("[.,;:!?\x0a-\x0d]"), re.compile("[^\x20\x09]+")


def brute(rows, least, longest=5, top=2000, cover=100):
    """rows of (lang, text)"""
    counts, total = collections.defaultdict(collections.Counter), collections.Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in BREAK.split((text or "").translate(LOWER)):
            ws = WORD.findall(piece)
            total[lang] += len(ws)
            for m in range(1, longest + 1):
                counts[lang].update(tuple(ws[i:i + m]) for i in range(len(ws) - m + 1))
    out = []
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) >= 2 and a >= least}
        covered = set()
        for p, a in candidates.items():
            for m in range(2, len(p)):
                covered.update(p[i:i + m] for i in range(len(p) - m + 1) if 100 * a >= cover * f[p[i:i + m]])
        found = []
        for p, a in candidates.items():
            if p not in covered:
                score, k = min((1000 * a * total[lang] // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
                found.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        out += [(lang, n, p.decode(), -a, l, r, total[lang], -s) for n, (s, a, p, l, r) in enumerate(sorted(found)[:top], 1)]
    return sorted(out)


def result(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def mixed(seed, n):
    dice = random.Random(seed)
    bits = ["the", "The", "of", "a", "b", "é", "x-y", ".", ",", "\n", "\t", "in the end", "on and on and on", "\r", "\x0b", "ÀB", "  "]
    rows = []
    for i in range(n):
        text = " ".join(dice.choice(bits) for _ in range(dice.randint(0, 60)))
        rows.append((i, text, dice.choice(["en", "en", "de", None, ""]), "s", len(text)))
    return rows


def test_equals_brute_force_on_mixed_texts(spark):
    rows = mixed(1, 300)
    for least, cover in ((4, 100), (12, 80)):
        got = result(P.mine_phrases(frame(spark, rows).repartition(5), least=least, cover=cover))
        assert got == brute([(r[2], r[1]) for r in rows], least, cover=cover) and got


def test_top_and_ties(spark):
    rows = mixed(2, 200)
    assert result(P.mine_phrases(frame(spark, rows), least=3, top=7)) == brute([(r[2], r[1]) for r in rows], 3, top=7)


def test_shards_and_sections_of_any_size(spark, monkeypatch):
    rows = mixed(3, 120)
    df = frame(spark, rows).repartition(3).select("lang", "text").toArrow().to_batches()
    want = brute([(r[2], r[1]) for r in rows], 5)
    assert want == result(P.mine_phrases(frame(spark, rows), least=5))
    from pyspark.taskcontext import TaskContext
    monkeypatch.setattr(TaskContext, "get", classmethod(lambda cls: type("T", (), {"partitionId": lambda self: 1})()))
    monkeypatch.setattr(P, "SHARD_WORDS", 50)
    monkeypatch.setattr(P, "SECTION_BYTES", 7)
    words = collections.Counter()
    shards = set()
    import pyarrow as pa
    filled = [pa.RecordBatch.from_arrays([b.column(0).fill_null("und"), b.column(1)], ["lang", "text"]) for b in df]
    for b in P._shards(iter(filled)):
        for r in b.to_pylist():
            if r["kind"] == 1:
                words[r["lang"], r["word"]] += r["n"]
            else:
                shards.add(r["shard"])
                assert len(P.unsqueeze(r["blob"], 2)[0]) == r["n"]
    plain = collections.Counter(("und" if r[2] is None else r[2], w) for r in rows
                                for p in BREAK.split(r[1].translate(LOWER)) for w in WORD.findall(p))
    assert words == plain and len(shards) > 10


def test_many_ranges_and_a_heavy_state(spark, monkeypatch):
    rows = [(i, " ".join(f"the w{i * j % 23} a" for j in range(1, 40)), "en", "s", 0) for i in range(60)]
    want = brute([(r[2], r[1]) for r in rows], 6)
    monkeypatch.setattr(P, "RANGE_WORDS", 7)
    monkeypatch.setattr(P, "RANGE_WEIGHT", 90)
    df = frame(spark, rows).repartition(4)
    assert result(P.mine_phrases(df, least=6)) == want
    step = P._extend([(3, 4000)], 10)
    import numpy as np
    import pyarrow as pa
    places = np.arange(4000)
    arcs = np.where(places % 2, 1 + places // 2, 0)  # the first word before many others
    shard = pa.table({"shard": [5], "blob": [P.squeeze(np.diff(places, prepend=0), arcs)]})
    n = 2001
    f = np.where(np.arange(n) == 0, 2000, 1)
    target = (3 << P._RANGE_BITS) + 1 + np.arange(n)
    alive = pa.table({"of": [5], "blob": [P.squeeze(np.diff(np.arange(n), prepend=0), target, target, np.cumsum(f) - f, f)]})
    got = [r for r in step(shard, alive).to_pylist() if r["kind"] == 1]
    assert len(got) == 10 and max(r["n"] for r in got) < 3 * min(r["n"] for r in got)


def test_edge_rows_and_empty_table(spark):
    rows = edge_rows() * 3
    assert result(P.mine_phrases(frame(spark, rows), least=3)) == brute([(r[2], r[1]) for r in rows], 3)
    assert P.mine_phrases(frame(spark, [])).collect() == []
    assert P.mine_phrases(frame(spark, [(1, None, "en", "a", 0), (2, "", None, "a", 0)])).collect() == []


def test_scores_are_exact_beyond_64_bits(spark):
    from pyspark.sql import functions as F
    f, n, l, r = 4_000_000_000_000, 9_000_000_000_000_000, 5_000_000_000_000, 7_000_000_000_000
    df = spark.createDataFrame([(f, n, [l], [r])], "f bigint, n bigint, firsts array<bigint>, rests array<bigint>")
    assert df.select(P._score(1, 2).getField("score").cast("long").alias("s")).first()["s"] == 1000 * f * n // (l * r)


def test_query_on_whole_table(spark):
    rows = [(r.lang, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("lang", "text").collect()]
    assert result(queries.op11_phrase_collocations(spark, SF_SMALL)) == brute(rows, 100)
