"""LM scoring: stupid-backoff scores by joining n-grams with hash-partitioned count tables.

score(w | v) = c(v w) / c(v) if c(v w) >= ``MIN_COUNT``, else ``BACKOFF`` * c(w) / N; the first
word of a text is scored by c(w) / N.  Counts cover all texts.

* The texts are written once as compressed chunks of a few megabytes.
* A chunk is exploded into its distinct n-grams with their counts there, dealt to buckets
  by hash: a chunk holds an n-gram once, however often or in however many copies it
  occurs, so no n-gram is hot.  Sorted hashes are packed as compressed differences: a
  shuffled n-gram takes a few bytes.
* A bucket's task adds up the counts, which is its part of the count table, and joins
  them back to the chunks that asked.
* A chunk's task joins the counts to its texts' words and sums the logarithms per text.

Defined cases: null, empty and wordless texts have no words, no back-offs and a null
score; repeated rows count and are scored each; null ids are kept; an empty table gives
no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise
from .textarrays import chunks, mix64, releasing, releasing_groups, word_hashes

BACKOFF = 0.4
MIN_COUNT = 2
#: UTF-8 bytes of text whose n-grams are taken together.
CHUNK_TEXT = 4 << 20
#: Bits of a hash that are kept beside the bucket number.
KEPT_BITS = 48
_PAIR = np.uint64(0xD6E8FEB86659FD93)


def ngrams(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of all words of the rows in order: row, word hash, hash of the pair it ends, whether it starts a row."""
    rows, words = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    for first, _, data, offsets in chunks(column):
        h, r = word_hashes(data, offsets, lower=False)
        rows.append(r + first)
        words.append(h)
    row, word = np.concatenate(rows), np.concatenate(words)
    starts = np.ones(len(row), bool)
    starts[1:] = row[1:] != row[:-1]
    pair = np.zeros(len(word), np.uint64)
    pair[1:] = mix64(word[:-1] * _PAIR + word[1:])
    return row, word, pair, starts


def keyed(word: np.ndarray, pair: np.ndarray, starts: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct n-grams of a chunk as (bucket, kept bits) in order, the counts, and where each word and pair stands."""
    every = np.concatenate([word, pair[~starts]])
    code = (every % np.uint64(buckets) << np.uint64(KEPT_BITS)) | (mix64(every) >> np.uint64(64 - KEPT_BITS))
    distinct, at, counts = np.unique(code, return_inverse=True, return_counts=True)
    pair_at = np.zeros(len(word), np.int64)
    pair_at[~starts] = at[len(word):]
    return distinct, counts, at[:len(word)], pair_at


def _planes(values: np.ndarray) -> bytes:
    return zlib.compress(np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8).T).tobytes(), 1)


def _unplanes(blob: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(zlib.decompress(blob), np.uint8).reshape(8, -1).T).view("<u8").reshape(-1)


def _chunk_texts(row: dict) -> pa.Array:
    """The texts of a stored chunk."""
    data = zstandard.ZstdDecompressor().decompress(row["texts"], max_output_size=max(1, sum(row["sizes"])))
    offsets = np.concatenate([[0], np.cumsum(row["sizes"])]).astype(np.int64)
    return pa.LargeStringArray.from_buffers(len(row["sizes"]), pa.py_buffer(offsets), pa.py_buffer(data))


def _store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (id, text) to one row per chunk: its number, ids, sizes in bytes and compressed texts."""
    def flush() -> pa.RecordBatch:
        packed = zstandard.ZstdCompressor(level=6).compress(b"".join(texts))
        return pa.RecordBatch.from_arrays([pa.array([number]), pa.array([ids], pa.list_(id_type)), pa.array([sizes], pa.list_(pa.int64())),
                                           pa.array([packed], pa.binary())], ["chunk", "ids", "sizes", "texts"])
    number, ids, sizes, texts, held, id_type = TaskContext.get().partitionId() << 24, [], [], [], 0, pa.int64()
    for batch in batches:
        id_type = batch.schema.field(0).type
        keys = batch.column(0).to_pylist()
        for first, end, data, offsets in chunks(batch.column(1)):
            ids += keys[first:end]
            sizes += np.diff(offsets).tolist()
            texts.append(data.tobytes())
            held += len(data)
            if held >= CHUNK_TEXT:
                yield flush()
                number, ids, sizes, texts, held = number + 1, [], [], [], 0
    if ids:
        yield flush()


def _explode(buckets: int):
    """Stored chunks to one row per chunk and bucket: the n-grams' hashes and counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                _, word, pair, starts = ngrams(_chunk_texts(row))
                distinct, counts, _, _ = keyed(word, pair, starts, buckets)
                kept = distinct & np.uint64((1 << KEPT_BITS) - 1)
                used, begin = np.unique((distinct >> np.uint64(KEPT_BITS)).astype(np.int32), return_index=True)
                parts = zip(np.split(kept, begin[1:]), np.split(counts, begin[1:])) if len(used) else ()
                blobs = [(_planes(np.diff(h, prepend=np.uint64(0))), _planes(c)) for h, c in parts]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(used), row["chunk"])), pa.array(used), pa.array([b[0] for b in blobs], pa.binary()),
                                                  pa.array([b[1] for b in blobs], pa.binary())], ["chunk", "bucket", "hashes", "counts"])
    return run


def _count(table: pa.Table) -> pa.Table:
    """One bucket: adds the chunks' counts and answers each chunk in the order of its hashes."""
    asked = [np.cumsum(_unplanes(h), dtype=np.uint64) for h in table.column("hashes").to_pylist()]
    counts = [_unplanes(c) for c in table.column("counts").to_pylist()]
    distinct, at = np.unique(np.concatenate(asked), return_inverse=True)
    total = np.zeros(len(distinct), np.uint64)
    np.add.at(total, at, np.concatenate(counts))
    answers = np.split(total[at], np.cumsum([len(a) for a in asked])[:-1])
    return pa.table({"chunk": table.column("chunk"), "bucket": table.column("bucket"), "totals": pa.array([_planes(a) for a in answers], pa.binary())})


def _score(buckets: int, words: int, backoff: float, min_count: int):
    def run(stored: pa.Table, answers: pa.Table) -> pa.Table:
        record = stored.to_pylist()[0]
        texts, ids = _chunk_texts(record), pa.array(record["ids"], stored.schema.field("ids").type.value_type)
        n = len(texts)
        row, word, pair, starts = ngrams(texts)
        _, _, word_at, pair_at = keyed(word, pair, starts, buckets)
        parts = sorted(zip(answers.column("bucket").to_pylist(), answers.column("totals").to_pylist()))
        totals = np.concatenate([_unplanes(b) for _, b in parts]).astype(np.float64) if parts else np.zeros(0)
        own = totals[word_at]
        joint = np.where(starts, 0.0, totals[pair_at] if len(pair_at) else 0.0)
        before = np.ones(len(own))
        before[1:] = own[:-1]
        seen = ~starts & (joint >= min_count)
        logs = np.where(seen, np.log(np.where(seen, joint, 1.0) / before), np.log(np.where(starts, 1.0, backoff) * own / max(words, 1)))
        size = np.bincount(row, minlength=n)
        sums = np.bincount(row, logs, minlength=n).astype(np.float64)
        back = np.bincount(row, ~seen & ~starts, minlength=n).astype(np.int64)
        return pa.table({"id": ids, "n_words": pa.array(size), "n_backoffs": pa.array(back), "log_score": pa.array(sums, mask=size == 0)})
    return run


def score_documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", backoff: float = BACKOFF,
                    min_count: int = MIN_COUNT) -> DataFrame:
    """One row per document: id, n_words, n_backoffs, log_score (natural logarithm, summed over its words)."""
    spark = df.sparkSession
    buckets = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    src = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    kind = src.schema["id"].dataType.simpleString()
    stored = materialise(src.mapInArrow(releasing(_store), f"chunk bigint, ids array<{kind}>, sizes array<bigint>, texts binary"), "lm-chunks")
    asked = stored.select("chunk", "sizes", "texts").mapInArrow(releasing(_explode(buckets)), "chunk bigint, bucket int, hashes binary, counts binary")
    answers = asked.groupBy("bucket").applyInArrow(releasing_groups(_count), "chunk bigint, bucket int, totals binary")
    words = src.agg(F.sum(F.regexp_count("text", F.lit("[^\\x20\\x09-\\x0D]+"))).alias("n")).first()["n"] or 0
    answers = answers.toDF("of_chunk", "bucket", "totals")
    return stored.groupBy("chunk").cogroup(answers.groupBy("of_chunk")).applyInArrow(
        releasing_groups(_score(buckets, int(words), backoff, min_count)), f"id {kind}, n_words bigint, n_backoffs bigint, log_score double")


def oracle_sql(backoff: float = BACKOFF, min_count: int = MIN_COUNT) -> str:
    """The registered query in DuckDB SQL."""
    return f"""WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
    tokens AS (SELECT rid, unnest(w) AS w, generate_subscripts(w, 1) AS i FROM docs),
    pairs AS (SELECT rid, i, w, lag(w) OVER (PARTITION BY rid ORDER BY i) AS v FROM tokens),
    one AS (SELECT w, count(*) AS c FROM tokens GROUP BY w),
    two AS (SELECT v, w, count(*) AS c FROM pairs WHERE v IS NOT NULL GROUP BY v, w HAVING count(*) >= {min_count}),
    scored AS (SELECT p.rid, CASE WHEN two.c IS NOT NULL THEN ln(two.c::DOUBLE / before.c)
        ELSE ln(CASE WHEN p.v IS NULL THEN 1.0::DOUBLE ELSE {backoff}::DOUBLE END * own.c / (SELECT count(*) FROM tokens)) END AS s,
        CASE WHEN p.v IS NOT NULL AND two.c IS NULL THEN 1 ELSE 0 END AS b
      FROM pairs p JOIN one own ON p.w = own.w LEFT JOIN one before ON p.v = before.w LEFT JOIN two ON p.v = two.v AND p.w = two.w),
    sums AS (SELECT rid, count(*) AS n, sum(b) AS b, sum(s) AS s FROM scored GROUP BY rid)
    SELECT doc_id, coalesce(n, 0) AS n_words, CAST(coalesce(b, 0) AS BIGINT) AS n_backoffs, round(s / n, 6) AS score
    FROM docs LEFT JOIN sums USING (rid)"""
