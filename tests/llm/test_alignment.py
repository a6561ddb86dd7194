"""Tokenizer alignment against whole-text encoding and counting in plain Python."""

import collections
import hashlib
import random

import public_tokenizers
import pytest

from llm_helpers import SF_SMALL, edge_rows, frame, plain

from chronofit.llm import queries
from chronofit.llm import token_alignment as T

A, B = str(public_tokenizers.path("byte_bpe_50k.json")), str(public_tokenizers.path("piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def aligner():
    return T.Aligner(A, B)


def whole(aligner, text):
    """Ends by plain loops over whole-text encodings: (n_a, n_b, groups, counter of linked pairs) or None."""
    full = (" " + text).encode()
    a = aligner.a.encode(" " + text, add_special_tokens=False).ids
    b = aligner.b.encode(text) if text else []
    if not text or b"".join(aligner.bytes_a[i] for i in a) != full or b"".join(aligner.bytes_b[i] for i in b) != full:
        return None
    spans = []
    for ids, table in ((a, aligner.bytes_a), (b, aligner.bytes_b)):
        at, own = 0, []
        for i in ids:
            own.append((at, at + len(table[i]), i))
            at += len(table[i])
        spans.append(own)
    ends = sorted({e for _, e, _ in spans[0]} & {e for _, e, _ in spans[1]})
    groups, low = [], 0
    for end in ends:
        sides = [",".join(str(i) for x, y, i in own if low <= x and y <= end) for own in spans]
        groups.append("|".join(sides))
        low = end
    links = collections.Counter((i, j) for x, y, i in spans[0] for u, v, j in spans[1] if x < v and u < y)
    return len(a), len(b), groups, links


def expected(aligner, rows):
    found = [(i, whole(aligner, t or "")) for i, t in rows]
    count = collections.Counter(p for _, x in found if x for p in x[3])
    best = collections.defaultdict(int)
    for (a, _), n in count.items():
        best[a] = max(best[a], n)
    out = []
    for i, x in found:
        if x is None:
            out.append((i, 0, 0, 0, 0, 0, 0, ""))
        else:
            out.append((i, x[0], x[1], len(x[2]), sum(x[3].values()), sum(n for p, n in x[3].items() if count[p] == best[p[0]]),
                        sum(n * count[p] for p, n in x[3].items()), hashlib.sha256(";".join(x[2]).encode()).hexdigest()))
    return sorted(out, key=repr)


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


ODD = ["a", "foo ", "  foo", "foo\n bar  \n  x", "<s> x<|endoftext|> y", "\tab \t c", "ﬁ Ａ é à", "don't  we're", "▁x y",
       "a　b  c  d", "1 2  33 é é", "x;\r\n y\r", "🙂 🙂🙂 a", "\u0085 \u0085b c", "end.\nStart", "a\u0000 b", " ", "  ", "a,b.c\n\nd'll é, ×, ÷; x)\n(y", "l'été\nñ-n a_b 1.2 x.3"]


def test_units_give_the_tokens_of_whole_texts(aligner):
    dice = random.Random(3)
    bits = [",", "'", "\n\n", "-", "×", " ", "  ", "a", "é", "\n", "\t", " ", ".", "'s", "1", " ", "ß", "Ω", " the", "\x1c", "\x7f", "ת"]
    texts = ODD + ["".join(dice.choice(bits) for _ in range(dice.randint(1, 12))) for _ in range(400)]
    for text in texts:
        stats, digests, _ = T.align_texts(aligner, [text.encode()])
        want = whole(aligner, text)
        if want is None:
            assert stats[0].tolist() == [0] * 5 and digests == [""]
        else:
            assert stats[0][:4].tolist() == [want[0], want[1], len(want[2]), sum(want[3].values())], text
            assert digests == [hashlib.sha256(";".join(want[2]).encode()).hexdigest()]


def test_edge_rows_repeats_and_clashing_names(spark, aligner):
    rows = [*edge_rows(), *plain((100 + i, t) for i, t in enumerate(ODD))]
    got = result(T.align_tokenizers(frame(spark, rows), A, B))
    assert got == expected(aligner, [(r[0], r[1]) for r in rows])


def test_empty_table(spark):
    assert T.align_tokenizers(frame(spark, []), A, B).collect() == []


def test_query_with_many_runs_parts_and_sections(spark, aligner, monkeypatch):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    want = expected(aligner, rows)
    assert result(queries.op12_cross_tokenizer_alignment(spark, SF_SMALL)) == want
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(7)
    monkeypatch.setattr(T, "PART_BYTES", 400)  # radixes are cut into parts and merged in a tree
    monkeypatch.setattr(T, "FAN_IN", 2)
    assert T._parts(spark.createDataFrame([(1, b"a" * 900, b""), (2, b"b" * 100, b"x")], "radix int, head binary, body binary")) == [(1, 3), (2, 1)]
    assert result(T.align_tokenizers(df, A, B)) == want


def test_long_texts_in_sections(aligner, monkeypatch):
    text = " ".join(f"word{i % 91} é\n" for i in range(3000))
    monkeypatch.setattr(T, "SECTION_BYTES", 500)
    stats, digests, (_, pairs, links) = T.align_texts(aligner, [text.encode(), b"short one"])
    want = whole(aligner, text)
    assert stats[0][:4].tolist() == [want[0], want[1], len(want[2]), sum(want[3].values())]
    assert digests[0] == hashlib.sha256(";".join(want[2]).encode()).hexdigest()
    assert len(T.unpack_counts(T.pack_counts(pairs[:5].cumsum(), links[:5]), 5)[0]) == 5


def test_forgotten_units_are_aligned_anew(aligner, monkeypatch):
    texts = [" ".join(f"w{j * i % 37}, x{i}" for j in range(30)).encode() for i in range(40)]
    want = [T.align_texts(aligner, [t]) for t in texts]
    monkeypatch.setattr(T, "CACHE_UNITS", 50)
    small = T.Aligner(A, B)
    for _ in range(2):
        for text, (stats, digests, records) in zip(texts, want):
            got = T.align_texts(small, [text])
            assert (got[0] == stats).all() and got[1] == digests
            assert all((x == y).all() for x, y in zip(got[2], records))
            assert len(small.groups) < 200


def test_merge_counts_every_key_once(monkeypatch):
    import numpy as np
    monkeypatch.setattr(T, "BLOCK", 3)
    rng = np.random.default_rng(5)
    runs = [(np.unique(rng.integers(0, 1 << 40, n)) % 997, None) for n in (0, 1, 40, 7, 300)]
    runs = [(np.unique(k), rng.integers(1, 1 << 35, len(np.unique(k)))) for k, _ in runs]
    total = collections.Counter()
    for keys, counts in runs:
        total.update(dict(zip(keys.tolist(), counts.tolist())))
    keys, counts = T.merge_counts(runs)
    assert list(zip(keys.tolist(), counts.tolist())) == sorted(total.items())
    again = T.unpack_counts(T.pack_counts(keys, counts), len(keys))
    assert (again[0] == keys).all() and (again[1] == counts).all()
