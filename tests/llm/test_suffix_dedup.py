import hashlib

import pytest

from chronofit.llm import suffix_dedup
from chronofit.llm.common import read
from llm_helpers import SF_SMALL, frame, long_text, plain


def expected(rows, length):
    """Every string in order of (id, start); a string seen before marks its bytes."""
    seen, out = set(), []
    for i, t in sorted(rows, key=lambda r: r[0]):
        data = (t or "").encode()
        covered = bytearray(len(data))
        for s in range(len(data) - length + 1):
            piece = data[s:s + length]
            if piece in seen:
                covered[s:s + length] = b"\1" * length
            seen.add(piece)
        kept = bytes(b for b, c in zip(data, covered) if not c)
        spans = sum(1 for j in range(len(data)) if covered[j] and (j == 0 or not covered[j - 1]))
        out.append((i, len(data), sum(covered), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def result(df, **options):
    return sorted((r["id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in suffix_dedup.remove_repeats(df, **options).collect())


def shared():
    passage, other = long_text(1, 60), long_text(2, 45)
    rows = [(i, f"{long_text(10 + i, i % 9)} {passage[i % 5:]} {long_text(30 + i, 12)} {other if i % 3 else other[7:150]}") for i in range(40)]
    rows += [(100, passage), (101, "ab" * 300), (102, "xab" + "ab" * 120), (103, "é" * 200), (104, None), (105, ""), (106, "short"), (107, "short"),
             (108, passage + passage), (109, rows[3][1]), (110, rows[3][1]), (111, long_text(1, 60)[:99]), (112, "z" * 1000 + passage[20:])]
    return rows


@pytest.mark.parametrize("batches", [1, 3, 6])
def test_matches_brute_force(spark, batches):
    rows = shared()
    assert result(frame(spark, plain(rows)), batches=batches) == expected(rows, 100)


def test_hot_suffix_starts_are_split(spark):
    rows = shared()
    assert result(frame(spark, plain(rows), False), hot_edges=3) == expected(rows, 100)


def test_documents(spark):
    rows = [(r["doc_id"], r["text"]) for r in read(spark, SF_SMALL, "documents", "doc_id", "text").collect()]
    assert result(read(spark, SF_SMALL, "documents")) == expected(rows, 100)


def test_other_lengths_and_flushes(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "RUN_ENTRIES", 50)
    rows = shared()
    assert result(frame(spark, plain(rows), False), length=60) == expected(rows, 60)


@pytest.mark.parametrize("size", [128, 333])
def test_texts_over_many_sections(spark, monkeypatch, size):
    monkeypatch.setattr(suffix_dedup, "SECTION_BYTES", size)
    rows = shared()
    assert result(frame(spark, plain(rows), False)) == expected(rows, 100)
    assert result(frame(spark, plain(rows), False), batches=5, hot_edges=3) == expected(rows, 100)
    assert any(r["section"] > 3 for r in suffix_dedup._ranked(spark.createDataFrame([(1, b"k", 5000)], "id bigint, text_key binary, n_bytes bigint"), 100).collect())


def test_many_buckets_and_groups(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "BUCKET_BYTES", 500)
    monkeypatch.setattr(suffix_dedup, "GROUP_EDGES", 4)
    rows = shared()
    assert result(frame(spark, plain(rows), False)) == expected(rows, 100)


def test_kept_text_and_carried_columns(spark):
    rows = shared()
    out = suffix_dedup.remove_repeats(frame(spark, plain(rows)), carry=("source", "rank"), with_text=True).collect()
    want = {i: (n, sha) for i, _, n, _, sha in expected(rows, 100)}
    for r in out:
        assert r["carry_source"] == "en" or r["carry_source"] == "a"
        if r["id"] != 103:  # there a cut may fall inside a character
            assert (r["n_removed"], hashlib.sha256(r["kept_text"].encode()).hexdigest()) == want[r["id"]]


def test_edges(spark):
    out = suffix_dedup.remove_repeats(frame(spark)).collect()
    by_id = {r["id"]: r for r in out}
    assert len(out) == 15 and by_id[1]["n_removed"] == 0 and by_id[2]["n_removed"] == by_id[2]["n_bytes"] and by_id[4]["n_removed"] == 0
    assert suffix_dedup.remove_repeats(frame(spark, [])).count() == 0
    # of equal ids, rows equal in text count as one document
    same = suffix_dedup.remove_repeats(frame(spark, plain([(1, long_text(3, 50))] * 2 + [(2, long_text(3, 50))]))).collect()
    assert sorted((r["id"], r["n_removed"] > 0) for r in same) == [(1, False), (1, False), (2, True)]


def test_levels_grow_like_a_binary_counter(spark):
    index = suffix_dedup.SuffixIndex(4)
    sizes = []
    for b in range(6):
        index.add(spark.createDataFrame([(b, long_text(50 + b, 80))], "rank bigint, text string"))
        sizes.append(sorted(index.levels))
    assert sizes == [[0], [1], [0, 1], [2], [0, 2], [1, 2]]
