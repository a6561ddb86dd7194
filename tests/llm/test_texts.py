"""Language ID, fingerprints, LM scores and packing."""

import hashlib
import itertools
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from chronofit.llm import language_id, lm_scores, lz_fingerprint, packing, queries
from chronofit.llm.common import read
from llm_helpers import SF_SMALL, frame, plain, words


def test_held_out_accuracy(spark):
    out = queries.op2_language_id(spark, SF_SMALL).collect()
    truth = {r["doc_id"]: r["lang"] for r in read(spark, SF_SMALL, "documents", "doc_id", "lang").collect()}
    held = [r for r in out if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in out)
    assert held and sum(r["lang_pred"] == truth[r["doc_id"]] for r in held) >= 0.95 * len(held)
    assert all(0 <= r["score"] <= 1 for r in out)


def test_labels_of_predicted_documents_do_not_matter(spark):
    from pyspark.sql import functions as F
    docs = read(spark, SF_SMALL, "documents")
    other = docs.withColumn("lang", F.when(language_id.held_out(F.col("doc_id")), F.lit("xx")).otherwise(F.col("lang"))).withColumn("source", F.lit("q"))
    a, b = ({r["id"]: r["lang_pred"] for r in language_id.predict_languages(d).collect()} for d in (docs, other))
    assert a == b


def test_gram_vectors_are_bound_permuted_letters():
    (counts, vectors), = language_id.gram_blocks(["abc"])
    border, a, b, c = (language_id.letter_vector(x) for x in (0, *map(ord, "abc")))
    expected = [np.roll(x, 2) * np.roll(y, 1) * z for x, y, z in ((border, a, b), (a, b, c), (b, c, border))]
    assert counts.tolist() == [[1, 1, 1]] and all(any((v == e).all() for v in vectors) for e in expected)
    # rows of one chunk do not mix, letter case and kind of border do not matter
    (two, _), = language_id.gram_blocks(["Ab--c d", "ab C\td"])
    assert (two[0] == two[1]).all()
    assert list(language_id.gram_blocks(["", "12", " - "])) == []


def test_blocks_of_grams_sum_to_the_whole(monkeypatch):
    texts = ["the cat sat on the mat", "él niño", "", "日本語テキスト"]
    (counts, vectors), = language_id.gram_blocks(texts)
    monkeypatch.setattr(language_id, "BLOCK", 4)
    parts = list(language_id.gram_blocks(texts))
    assert len(parts) > 3 and np.allclose(sum(c @ v for c, v in parts), counts @ vectors)


def test_language_edges(spark):
    out = [(r["id"], r["lang_pred"], r["score"]) for r in language_id.predict_languages(frame(spark), carry=("text", "n")).collect()]
    by_id = {i: (p, s) for i, p, s in out}
    assert len(out) == 15 and by_id[4] == by_id[5] == by_id[6] == by_id[13] == ("und", 0.0) and by_id[1][0] == "en"
    assert by_id[7][0] != "und" and by_id[8][0] != "und"  # a letter is enough
    unlabelled = plain([(1, "abc def")])
    untrained = [(i, t, None, s, n) for i, t, _, s, n in unlabelled]
    assert [r["lang_pred"] for r in language_id.predict_languages(frame(spark, untrained)).collect()] == ["und"]
    assert language_id.predict_languages(frame(spark, [])).count() == 0


def plain_lz(text):
    known, piece, out = set(), "", []
    for c in text:
        piece += c
        if piece not in known:
            known.add(piece)
            out.append(piece)
            piece = ""
    return out


def expected_fingerprints(rows):
    """(n_chars, sha, fingerprint, edited, near_edited, near_next) by the definition; rows in descending order."""
    out = []
    for i, (_, t) in enumerate(rows):
        text, following = t or "", rows[(i + 1) % len(rows)][1] or ""
        half = len(text) // 2
        other = text[:len(text) - half] + following[:half]
        own, edit, after = (lz_fingerprint.signature(plain_lz(x)) for x in (text, other, following))
        out.append((len(text), hashlib.sha256(other.encode()).hexdigest(), own.hex(), edit.hex(),
                    lz_fingerprint.likeness(own, edit), lz_fingerprint.likeness(own, after)))
    return out


@pytest.mark.parametrize("parts", ["1", "8"])
def test_fingerprints_match_the_definition(spark, parts):
    rows = [(r["doc_id"], r["text"]) for r in read(spark, SF_SMALL, "documents", "doc_id", "text").collect()]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        got = {r["doc_id"]: r for r in queries.op4_lz_fingerprint(spark, SF_SMALL).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    rows.sort(reverse=True)
    for (i, _), e in zip(rows, expected_fingerprints(rows)):
        r = got[i]
        assert (r["n_chars"], r["edited_sha256"], r["fingerprint"], r["edited_fingerprint"], r["near_edited"], r["near_next"]) == e


def test_fingerprint_edges(spark):
    rows = [(3, "aé" * 20), (2, None), (1, "x"), (0, "")]
    got = {r["id"]: r for r in lz_fingerprint.fingerprint_documents(frame(spark, plain(rows))).collect()}
    for (i, _), e in zip(rows, expected_fingerprints(rows)):
        assert (got[i]["n_chars"], got[i]["edited_sha256"], got[i]["fingerprint"], got[i]["edited_fingerprint"], got[i]["near_edited"], got[i]["near_next"]) == e
    assert lz_fingerprint.fingerprint_documents(frame(spark)).count() == 15
    assert lz_fingerprint.fingerprint_documents(frame(spark, [])).count() == 0
    alone = lz_fingerprint.fingerprint_documents(frame(spark, plain([(1, "abcd")]))).first()
    assert alone["edited_sha256"] == hashlib.sha256(b"abab").hexdigest() and alone["near_next"] == 1.0


def test_likeness_estimates_jaccard():
    rng, errors = random.Random(2), []
    for _ in range(80):
        pool = ["".join(rng.choices("abcdefgh", k=rng.randint(1, 9))) for _ in range(900)]
        a, b = set(pool[:600]), set(pool[300:])
        errors.append(lz_fingerprint.likeness(lz_fingerprint.signature(sorted(a)), lz_fingerprint.signature(sorted(b))) - len(a & b) / len(a | b))
    assert abs(np.mean(errors)) < 0.03 and np.std(errors) < 0.08


def test_lm_edges(spark):
    df = frame(spark)
    texts = [r["text"] for r in df.select("text").collect()]
    every = [words(t) for t in texts]
    one = Counter(w for t in every for w in t)
    two = Counter(p for t in every for p in zip(t, t[1:]))
    total, expected = sum(one.values()), []
    for t in every:
        s, back = 0.0, 0
        for v, w in zip([None, *t], t):
            if v is not None and two[v, w] >= 2:
                s += math.log(two[v, w] / one[v])
            else:
                back += v is not None
                s += math.log((1.0 if v is None else 0.4) * one[w] / total)
        expected.append((len(t), back, round(s, 6) if t else None))
    got = [(r["n_words"], r["n_backoffs"], None if r["log_score"] is None else round(r["log_score"], 6)) for r in lm_scores.score_documents(df).collect()]
    assert sorted(got, key=str) == sorted(expected, key=str)
    assert lm_scores.score_documents(frame(spark, [])).count() == 0
    assert [r["log_score"] for r in lm_scores.score_documents(frame(spark, plain([(1, None)]))).collect()] == [None]


def test_encoding_by_words_is_the_tokenizers_own():
    from tokenizers import Tokenizer
    whole = Tokenizer.from_file(queries.tokenizer_path())
    whole.encode_special_tokens = True
    texts = ["It's  we'LL\tO'Neil 12ab3.4!?\n\x0b don’t", "é e\u0301 ﬁ İI ΑΣ ς Ω\u00a0x\u2003y z\x85q", "a\x1cb \u200b \u0301x <\u0338 ", "a.. A!? é, €. …! x_. 5%% don't! 's. *** #a# (b). É;: \u0915\u094d. ²! a\u0301. x\u200b,", "<|endoftext|> 日本語テキスト 👩‍👩‍👧", "", " \n"]
    for text, ids in zip(texts, packing.encode(queries.tokenizer_path(), [t.encode() for t in texts])):
        assert np.frombuffer(ids, "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids


def check_packing(spark, df, texts, capacity):
    from tokenizers import Tokenizer
    whole = Tokenizer.from_file(queries.tokenizer_path())
    whole.encode_special_tokens = True
    rows = packing.pack_documents(df, queries.tokenizer_path(), capacity=capacity, with_ids=True).collect()
    expected = []
    for i, t in texts:
        ids = whole.encode(t or "", add_special_tokens=False).ids + [0]
        expected += [(i, n, at, tuple(ids[at:at + capacity])) for n, at in enumerate(range(0, len(ids), capacity))]
    key = lambda r: (str(r[0]), *r[1:])
    assert sorted(((r["id"], r["piece"], r["start"], tuple(r["ids"])) for r in rows), key=key) == sorted(expected, key=key)
    assert all(r["length"] == len(r["ids"]) and r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes()) for r in rows)
    for _, group in itertools.groupby(sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])), key=lambda r: r["sequence_id"]):
        at = 0
        for r in group:
            assert r["offset"] == at
            at += r["length"]
        assert at <= capacity
    return len({r["sequence_id"] for r in rows}), [r["length"] for r in rows]


def test_packing_round_trip(spark):
    df = frame(spark)
    texts = [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]
    for capacity in (64, 2048):
        used, lengths = check_packing(spark, df, texts, capacity)
        assert used >= packing.lower_bound(lengths, capacity)
    assert packing.pack_documents(frame(spark, []), queries.tokenizer_path()).count() == 0
    docs = read(spark, SF_SMALL, "documents")
    used, lengths = check_packing(spark, docs, [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()], 2048)
    assert used == packing.lower_bound(lengths, 2048)


def fewest_bins(lengths, capacity):
    """Exact by trying every assignment, largest first."""
    lengths, best = sorted(lengths, reverse=True), [len(lengths)]

    def place(i, rooms):
        if len(rooms) >= best[0]:
            return
        if i == len(lengths):
            best[0] = len(rooms)
            return
        for room in sorted(set(rooms)):
            if room >= lengths[i]:
                at = rooms.index(room)
                place(i + 1, rooms[:at] + [room - lengths[i]] + rooms[at + 1:])
        place(i + 1, [*rooms, capacity - lengths[i]])
    place(0, [])
    return best[0]


def test_bin_completion_is_valid_and_tight():
    rng, extra = random.Random(6), 0
    for _ in range(60):
        lengths = [rng.randint(15, 70) for _ in range(rng.randint(1, 11))]
        bins, exact = packing.bin_completion(lengths, 100), fewest_bins(lengths, 100)
        assert sorted(itertools.chain(*bins)) == sorted(lengths) and all(sum(b) <= 100 for b in bins)
        assert packing.lower_bound(lengths, 100) <= exact <= len(bins) <= len(packing.best_fit_decreasing(lengths, 100))
        extra += len(bins) - exact
    assert extra == 0
    # best-fit decreasing takes three bins here, two are enough
    assert len(packing.best_fit_decreasing([45, 35, 35, 30, 30, 25], 100)) == 3 and len(packing.bin_completion([45, 35, 35, 30, 30, 25], 100)) == 2


def all_undominated(pieces, room):
    """Sets (as sorted sizes) that fit and in which no larger unused piece fits instead of a chosen one or of nothing."""
    found = set()
    for n in range(len(pieces) + 1):
        for own in itertools.combinations(range(len(pieces)), n):
            chosen, left = [pieces[i] for i in own], room - sum(pieces[i] for i in own)
            rest = [pieces[i] for i in range(len(pieces)) if i not in own]
            if left >= 0 and not any(x < y <= x + left for x in [0, *chosen] for y in rest):
                found.add(tuple(sorted(chosen, reverse=True)))
    return found


def test_all_undominated_fillings_are_enumerated():
    assert list(packing.Search([60, 35, 30, 10], 10 ** 6).fillings(100, 100)) == [(60, 30, 10), (60, 35)]
    rng = random.Random(8)
    for _ in range(150):
        pieces = [rng.randint(1, 40) for _ in range(rng.randint(0, 9))]
        room = rng.randint(1, 90)
        got = list(packing.Search(pieces, 10 ** 6).fillings(room, room))
        assert len(got) == len(set(got)) and set(got) == all_undominated(pieces, room)
        for waste in (0, 3):
            assert set(packing.Search(pieces, 10 ** 6).fillings(room, waste)) == {f for f in set(got) if room - sum(f) <= waste}


@pytest.mark.parametrize("bins, each, capacity", [(6, 3, 100), (10, 3, 1000), (10, 3, 100), (8, 5, 500), (20, 6, 1000)])
def test_perfect_packings_are_found(bins, each, capacity):
    rng = random.Random(7)
    for _ in range(100):
        lengths = []
        for _ in range(bins):
            cuts = sorted(rng.sample(range(1, capacity), each - 1))
            lengths += [b - a for a, b in zip([0, *cuts], [*cuts, capacity])]
        rng.shuffle(lengths)
        found = packing.bin_completion(lengths, capacity)
        assert sorted(itertools.chain(*found)) == sorted(lengths) and len(found) == bins


def test_search_reaches_a_whole_packing_of_a_full_group(spark):
    docs = [(r["text"] or "").encode() for r in read(spark, "/root/testdata/sf0.1", "documents", "doc_id", "text").orderBy("doc_id").collect()]
    lengths = [n for ids in packing.encode(queries.tokenizer_path(), docs) if (n := (len(ids) // 4 + 1) % 2048)]
    real = random.Random(0).sample(lengths, 8192)
    rng = random.Random(1)
    for group in (real, [rng.randint(20, 200) for _ in range(8192)]):
        bins, bound = packing.bin_completion(group, 2048), packing.lower_bound(group, 2048)
        assert sorted(itertools.chain(*bins)) == sorted(group) and all(sum(b) <= 2048 for b in bins)
        # best-fit decreasing is not enough for these groups
        assert len(bins) == bound < len(packing.best_fit_decreasing(group, 2048))
    # far above the bound: a search that ends unfinished still has whole packings to choose from
    group = [rng.randint(150, 400) for _ in range(8192)]
    assert len(packing.bin_completion(group, 2048)) < len(packing.best_fit_decreasing(group, 2048))
