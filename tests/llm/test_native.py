"""Quality rules, license scan and URL filter."""

import hashlib
import random
import re
from collections import Counter

import pytest

from chronofit.llm import license_scan, quality_rules, queries, url_filter
from chronofit.llm.common import read
from chronofit.llm.license_texts import LICENSES, NOTICES
from llm_helpers import SF_SMALL, frame, long_text, plain, words

import oracle_harness


def statistics(text):
    text = text or ""
    w = words(text)
    grams = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
    count, covered = Counter(grams), set()
    for i, g in enumerate(grams):
        if count[g] > 1:
            covered.update(range(i, i + 5))
    lines = [x for x in text.split("\n") if words(x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), len(set(w)))


def check_statistics(df):
    rows = df.select("doc_id", "text").collect()
    got = quality_rules.text_statistics(df).collect()
    columns = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_distinct_words")
    key = lambda r: str(r)
    assert sorted(((r["id"], *(r[c] for c in columns)) for r in got), key=key) == sorted(((r["doc_id"], *statistics(r["text"])) for r in rows), key=key)


def test_statistics(spark):
    check_statistics(read(spark, SF_SMALL, "documents"))
    check_statistics(frame(spark))
    repeats = ["a b c d e " * 4, "a a a a a a a", "x\ny\nx\n\n \nx", "l1 a\nl1 a\n##\n##", "p q r s t u p q r s t v", "é# é# é# é# é# é#", "a b c d e f a b c d e"]
    check_statistics(frame(spark, plain(list(enumerate(repeats)))))
    check_statistics(frame(spark, []))


def test_decision_list_learns_conjunctions():
    rows = []
    for i in range(1200):
        share, repeat = (i * 37 % 100) / 100, (i * 53 % 97) / 97
        rows.append({n: 0.0 for n in quality_rules.features()} | {
            "symbol_share": share, "repeat_share": repeat, "bad": int(share > 0.6 and repeat > 0.5), "fold": i % 3})
    rules = quality_rules.learn_rules(rows)
    fired = [any(all(c.holds(r) for c in rule) for rule in rules) for r in rows]
    wrong = sum(f and not r["bad"] for f, r in zip(fired, rows))
    missed = sum(r["bad"] and not f for f, r in zip(fired, rows))
    assert rules and wrong <= 5 and missed <= 0.1 * sum(r["bad"] for r in rows)


def test_decision_list_needs_precision_and_labels():
    rng = random.Random(9)
    rows = [{n: rng.random() for n in quality_rules.features()} | {"bad": rng.randint(0, 1), "fold": i % 3} for i in range(600)]
    assert quality_rules.learn_rules(rows) == [] and quality_rules.learn_rules([]) == []


def test_verdicts_over_documents(spark):
    out = queries.op1_quality_rules(spark, SF_SMALL).collect()
    assert all(r["base_failed"] == (r["n_words"] < 10 or 100 * r["n_repeat_words"] > 20 * r["n_words"]) for r in out)
    assert all(r["kept"] == (not r["base_failed"] and r["rule"] is None) for r in out)


def test_quality_edges(spark):
    labels = spark.createDataFrame([(1, 1), (1, 0), (4, None), (None, 0)], "doc_id bigint, quality int")
    out = {(r["id"], r["n_words"]): r for r in quality_rules.judge_quality(frame(spark), labels).collect()}
    assert not out[(4, 0)]["kept"] and not out[(5, 0)]["kept"] and out[(1, 300)]["kept"]
    assert quality_rules.judge_quality(frame(spark, []), labels).count() == 0


def test_license_texts_in_other_spellings(spark):
    mit = LICENSES["MIT"]
    loud = "Copyright (c) 2024 Someone\n\n" + mit.upper().replace("SUBLICENSE", "SUBLICENCE").replace(", ", " ,\n ")
    part = "# Readme\nReleased under the  MIT licence!\n" + long_text(1, 30)
    df = frame(spark, plain([(1, mit), (2, loud), (3, mit + " more"), (4, None), (5, ""), (6, part), (7, "© me\n" + LICENSES["ISC"])]))
    out = {r["id"]: r for r in license_scan.scan_licenses(df).collect()}
    assert [out[i]["license_id"] for i in range(1, 8)] == ["MIT", "MIT", None, None, None, None, "ISC"]
    assert out[6]["notices"] == "MIT" and out[6]["n_notices"] == 1 and out[1]["canonical_sha256"] == out[2]["canonical_sha256"]
    assert out[4]["canonical_sha256"] == hashlib.sha256(b"").hexdigest()
    assert license_scan.scan_licenses(frame(spark, [])).count() == 0


def test_licences_in_comments(spark):
    bsd = LICENSES["BSD-3-Clause"]
    assert "Neither the name" in bsd and bsd != LICENSES["BSD-2-Clause"]
    forms = [(mark + " Copyright (c) 2020, A. Person\n" + mark + "\n" + "\n".join(mark + " " + line for line in bsd.split("\n"))) for mark in ("#", "//", " *", ";;", "--")]
    rows = plain([*enumerate(forms), (10, "- (c) choose wisely\n" + bsd)])
    out = {r["id"]: r["license_id"] for r in license_scan.scan_licenses(frame(spark, rows)).collect()}
    assert out == dict.fromkeys(range(5), "BSD-3-Clause") | {10: None}


def test_every_notice_is_found(spark):
    df = frame(spark, plain([(i, f"{long_text(i, 12)}\n{n}\n{n.upper()}") for i, n in enumerate(NOTICES)]))
    out = {r["id"]: (r["notices"], r["n_notices"]) for r in license_scan.scan_licenses(df).collect()}
    assert out == {i: (v, 2) for i, v in enumerate(NOTICES.values())}


def test_oracles(spark):
    for name, sql in queries.ORACLES.items():
        result = oracle_harness.compare(spark, name, SF_SMALL, queries.QUERIES[name], sql)
        assert result["columns_match"] and result["values_match"], result


PAGE = "page_id bigint, url string, html string, host string, rank int, r double"


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "clash", 1, 0.5) for i, (u, h) in enumerate(rows)], PAGE)


def test_rules_and_parts(spark):
    urls = ["http://WWW.Example.com/en/a?x=/fr/", "https://a.example.com/en/", "https://b.com", "https://b.com?q", "ftp://x.net/fr/#a",
            "http://net/es/1", "http://subnet/es/1", None, "no-scheme/en/", "http://x.com/y://z.net/fr/", "http://example.com/ENG/", "http://É.com/"]
    out = {r["id"]: (r["host"], r["path"], r["rule"]) for r in url_filter.judge_urls(pages(spark, [(u, None) for u in urls])).collect()}
    assert [out[i] for i in range(len(urls))] == [
        ("www.example.com", "/en/a", "www.example.com/en/"), ("a.example.com", "/en/", "example.com/en/"), ("b.com", "", None),
        ("b.com", "", None), ("x.net", "/fr/", "net/fr/"), ("net", "/es/1", "net/es/"), ("subnet", "/es/1", None), ("", "", None),
        ("", "", None), ("x.com", "/y://z.net/fr/", "com/"), ("example.com", "/ENG/", "com/"), ("É.com", "/", "com/")]


def test_reputation_follows_links(spark):
    rows = [("http://bad.net/es/1", ""), ("http://good.com/1", '<a href="http://friend.org/x"> <a href="//friend.org">'),
            ("http://spam.org/", '<A HREF=\'http://bad.net/es/9\'>'), ("http://friend.org/", ""), ("http://alone.org/", '<a href="/local">'),
            ("http://sub.spam.org/", None), (None, '<a href="http://bad.net/">')]
    out = {r["id"]: r["verdict"] for r in url_filter.judge_urls(pages(spark, rows)).collect()}
    # who links to a blocked host is distrusted, and so is its subdomain; who is linked from a trusted one is not
    assert [out[i] for i in range(7)] == ["block", "allow", "block", "allow", "allow", "block", "allow"]
    assert url_filter.judge_urls(pages(spark, [])).count() == 0


def brute_rank(seeds, edges, steps=400, damping=url_filter.DAMPING):
    out_w = Counter()
    for (a, _), w in edges.items():
        out_w[a] += w
    rank = dict(seeds)
    for _ in range(steps):
        new = {h: s * (1 - damping) for h, s in seeds.items()}
        for (a, b), w in edges.items():
            new[b] = new.get(b, 0.0) + damping * rank.get(a, 0.0) * w / out_w[a]
        rank = new
    return rank


def test_propagation_matches_plain_pagerank(spark):
    edges = {(f"h{i}", f"h{i * i % 17}"): float(i % 4 + 1) for i in range(1, 40)}
    trust, distrust = {"h1": 0.5, "h3": 0.5}, {"h2": 1.0}
    seeds = [(h, k, s) for k, group in (("trust", trust), ("distrust", distrust)) for h, s in group.items()]
    got = url_filter.propagate(spark.createDataFrame(seeds, "host string, kind string, seed double"),
                               spark.createDataFrame([(a, b, w) for (a, b), w in edges.items()], "src string, dst string, w double"))
    t, d = brute_rank(trust, edges), brute_rank(distrust, {(b, a): w for (a, b), w in edges.items()})
    for r in got.collect():
        assert abs(r["trust"] - t.get(r["host"], 0)) < 1e-9 and abs(r["distrust"] - d.get(r["host"], 0)) < 1e-9


@pytest.mark.parametrize("damping, limit", [(0.85, None), (0.3, 0)])
def test_propagation_converges_on_deep_graphs(spark, monkeypatch, damping, limit):
    if limit is not None:  # edges beyond the broadcast bound are joined by shuffling
        monkeypatch.setattr(url_filter, "broadcast_if_small", lambda df, *a, **b: df)
    n = 26
    edges = {(f"h{i}", f"h{i - 1}"): 1.0 for i in range(1, n)} | {("h11", "h3"): 2.0, ("h2", "h5"): 3.0, ("h0", "h9"): 1.0}
    trust, distrust = {"h11": 0.75, "h4": 0.25}, {"h0": 1.0}
    seeds = [(h, k, s) for k, group in (("trust", trust), ("distrust", distrust)) for h, s in group.items()]
    rows = url_filter.propagate(spark.createDataFrame(seeds, "host string, kind string, seed double"),
                                spark.createDataFrame([(a, b, w) for (a, b), w in edges.items()], "src string, dst string, w double"),
                                damping=damping).collect()
    t = brute_rank(trust, edges, 400, damping)
    d = brute_rank(distrust, {(b, a): w for (a, b), w in edges.items()}, 400, damping)
    assert {r["host"] for r in rows if r["trust"] > 0 or r["distrust"] > 0} == {h for h in set(t) | set(d) if max(t.get(h, 0), d.get(h, 0)) >= 5e-13}
    for r in rows:
        assert abs(r["trust"] - t.get(r["host"], 0)) < 2e-12 and abs(r["distrust"] - d.get(r["host"], 0)) < 2e-12


def test_deep_chains_of_links_are_judged_as_by_sql(spark, tmp_path):
    import duckdb
    rows = [("http://h0.net/es/1", ""), ("http://good.com/", '<a href="http://h7.org/">')] + [
        (f"http://h{i}.org/", f'<a href="http://h{i - 1}.{"net" if i == 1 else "org"}/">') for i in range(1, 25)]
    pages(spark, rows).withColumnRenamed("id", "page_id").write.parquet(str(tmp_path / "pages.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    want = sorted(con.execute(url_filter.oracle_sql()).fetchall())
    got = queries.op8_url_filter(spark, str(tmp_path))
    assert sorted(tuple(r) for r in got.collect()) == want
    assert sum(r[4] == "block" for r in want) > 12 and any(r[4] == "allow" for r in want)
