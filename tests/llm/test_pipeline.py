import importlib

from chronofit.llm import language_id
from chronofit.llm.common import read
from llm_helpers import SF_SMALL, frame, words
from test_near_dedup import expected as near_groups
from test_suffix_dedup import expected as repeats

import corpus_pipeline


def test_stage_list():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "near_dedup", "suffix_dedup", "source_mix", "packing"]


def test_stages_on_documents(spark):
    """Each stage against a brute-force version of it on its own input."""
    docs = read(spark, SF_SMALL, "documents")
    rows = {r["doc_id"]: r for r in docs.collect()}
    columns = docs.columns

    found = corpus_pipeline.identify_languages(spark, docs, SF_SMALL)
    assert found.columns == columns
    lettered = {i for i, r in rows.items() if any(c.isalpha() for c in r["text"] or "")}
    assert {r["doc_id"] for r in found.collect()} == lettered

    near = corpus_pipeline.drop_near_duplicates(spark, docs, SF_SMALL)
    groups = near_groups([(i, r["text"]) for i, r in rows.items()], 5, 80)
    assert near.columns == columns
    assert sorted(r["doc_id"] for r in near.collect()) == sorted(i for i, _, c in groups if i == c)

    cut = corpus_pipeline.remove_repeated_passages(spark, docs, SF_SMALL)
    want = {i: (n, gone) for i, n, gone, _, _ in repeats([(i, r["text"]) for i, r in rows.items()], 100)}
    got = {r["doc_id"]: r for r in cut.collect()}
    assert cut.columns == columns and set(got) == {i for i, (n, gone) in want.items() if gone < n or n == 0}
    for i, r in got.items():
        if want[i][1] == 0:
            assert r["text"] == rows[i]["text"] and r["n_chars"] == rows[i]["n_chars"]
        else:
            assert len(r["text"]) == r["n_chars"] < len(rows[i]["text"])

    mixed = corpus_pipeline.mix_sources(spark, docs, SF_SMALL)
    assert mixed.columns == columns
    total = sum(len(words(r["text"])) for r in rows.values())
    assert abs(sum(len(words(r["text"])) for r in mixed.select("text").collect()) - total) < 0.2 * total


def test_stages_on_edge_rows(spark):
    docs = frame(spark)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF_SMALL)
        assert out.columns == docs.columns, name
        assert stage(spark, frame(spark, []), SF_SMALL).count() == 0, name
    assert corpus_pipeline.pack_sequences(spark, docs, SF_SMALL).count() >= 15
    assert language_id.UNKNOWN == "und"


def test_run_and_registration(spark):
    entry = importlib.import_module("__spark_entry__")
    queries = entry.queries()
    assert all(any(n.startswith(f"op{k}_") for n in queries) for k in range(1, 11)) and "pipeline" in queries
    assert set(queries["pipeline"](spark, SF_SMALL).columns) >= {"doc_id", "piece", "length", "sequence_id", "offset"}


def test_other_operators_caches_are_dropped():
    from chronofit.llm import packing, textarrays
    from chronofit.llm.queries import tokenizer_path
    packing.word_ids(tokenizer_path())
    own = textarrays.releasing(packing._pieces(tokenizer_path(), 64, False))
    assert list(own(iter([]))) == [] and packing._workers
    from chronofit.llm import language_id
    assert len(list(textarrays.releasing(language_id._bundle)(iter([])))) == 1 and not packing._workers
