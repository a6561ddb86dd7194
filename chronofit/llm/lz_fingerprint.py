"""Document fingerprints from Lempel-Ziv phrases.

A text is parsed by LZ78 into phrases, each the shortest piece not yet in the
dictionary; the set of phrases is hashed, and a one-permutation minimum-hash signature
(128 slots, empty slots filled by rotation, 8 bits kept per slot) is its fingerprint.
The share of equal slots, corrected for chance equality, estimates the Jaccard likeness
of two phrase sets, which is large when the one text would compress well with the
dictionary of the other.

The edited query compares each text with its edited version and with the next document.
Documents are range-partitioned once by descending id, and each task passes over its
sorted rows holding one neighbour; only the texts at the borders of partitions meet in
a second, small join.

Defined cases: a null text is empty; an empty text has an all-zero fingerprint, likeness
1 with another empty text and 0 with any other; of equal ids the order is by text hash;
null ids come last; an only document is its own next; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise
from .textarrays import mix64, releasing, _power

SLOTS = 128
EMPTY = bytes(SLOTS)
_CHANCE = 1.0 / 255


def lz_phrases(text: str, known: list[str] | None = None, start: int = 0) -> list[str]:
    """Phrases of an LZ78 parse of ``text[start:]`` after the phrases ``known``, which come first."""
    out = list(known or ())
    seen = set(out)
    i, j, n = start, start + 1, len(text)
    while j <= n:
        piece = text[i:j]
        if piece in seen:
            j += 1
        else:
            seen.add(piece)
            out.append(piece)
            i, j = j, j + 1
    return out


def signature(phrases: list[str]) -> bytes:
    """128 slots of 8 bits; the zero byte is kept for the empty set."""
    if not phrases:
        return EMPTY
    codes = np.frombuffer("".join(phrases).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    ends = np.cumsum([len(p) for p in phrases])
    starts = np.concatenate([[0], ends[:-1]])
    prefix = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(mix64(codes + np.uint64(1)) * _power("up", len(codes)), out=prefix[1:])
    h = mix64((prefix[ends] - prefix[starts]) * _power("down", len(prefix))[starts])
    slots = np.full(SLOTS, np.iinfo(np.uint64).max, np.uint64)
    np.minimum.at(slots, (h % np.uint64(SLOTS)).astype(np.int64), h >> np.uint64(7))
    filled = slots != np.iinfo(np.uint64).max
    if not filled.all():  # an empty slot takes the next filled one, marked by its distance
        at = np.flatnonzero(filled)
        empty = np.flatnonzero(~filled)
        source = at[np.searchsorted(at, empty) % len(at)]
        slots[empty] = mix64(slots[source] + ((source - empty) % SLOTS).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return (mix64(slots) % np.uint64(255) + np.uint64(1)).astype(np.uint8).tobytes()


def likeness(a: bytes, b: bytes) -> float:
    if a == b:
        return 1.0
    if a == EMPTY or b == EMPTY:
        return 0.0
    same = float((np.frombuffer(a, np.uint8) == np.frombuffer(b, np.uint8)).mean())
    return max(0.0, (same - _CHANCE) / (1 - _CHANCE))


def edited(text: str, following: str) -> str:
    """The text with its last floor(n/2) code points replaced by the first as many of ``following``."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def compare(text: str, phrases: list[str], own: bytes, following: str, next_own: bytes) -> tuple:
    """edited_sha256, edited_fingerprint, near_edited, near_next of a document and the one after it."""
    other = edited(text, following)
    cut, end, known = len(text) - len(text) // 2, 0, 0
    for p in phrases:  # the parse is the same up to the last phrase that ends before the cut
        if end + len(p) > cut:
            break
        end += len(p)
        known += 1
    edit = signature(lz_phrases(other, phrases[:known], end))
    return (hashlib.sha256(other.encode("utf-8", "surrogatepass")).hexdigest(), edit, likeness(own, edit), likeness(own, next_own))


_OUT = "part int, place int, n_chars bigint, fingerprint binary, edited_sha256 string, edited_fingerprint binary, near_edited double, near_next double, text string"
_FIELDS = pa.schema([("part", pa.int32()), ("place", pa.int32()), ("n_chars", pa.int64()), ("fingerprint", pa.binary()),
                     ("edited_sha256", pa.string()), ("edited_fingerprint", pa.binary()), ("near_edited", pa.float64()),
                     ("near_next", pa.float64()), ("text", pa.string())])
#: ``place`` of a row: within the task, its first row (kept twice), its last row (still to be compared).
MIDDLE, FIRST, LAST = 0, 1, 2


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows (part, id, text): all but the last are compared with their successor."""
    held, id_type = None, None
    for batch in batches:
        id_type = batch.schema.field(1).type
        rows: list[tuple] = []
        ids: list = []
        for part, key, text in zip(*(c.to_pylist() for c in batch.columns)):
            phrases = lz_phrases(text)
            own = signature(phrases)
            if held is None:
                rows.append((part, FIRST, len(text), own, None, None, None, None, text))
                ids.append(key)
            else:
                rows.append((part, MIDDLE, len(held[1]), held[3], *compare(held[1], held[2], held[3], text, own), None))
                ids.append(held[0])
            held = (key, text, phrases, own, part)
        yield _batch(ids, rows, id_type)
    if held is not None:
        yield _batch([held[0]], [(held[4], LAST, len(held[1]), held[3], None, None, None, None, held[1])], id_type)


def _batch(ids: list, rows: list[tuple], id_type: pa.DataType) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * len(_FIELDS)
    return pa.RecordBatch.from_arrays([pa.array(ids, id_type), *[pa.array(list(c), f.type) for c, f in zip(columns, _FIELDS)]],
                                      ["id", *_FIELDS.names])


def _close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The last rows of the partitions with the first text after them."""
    for batch in batches:
        rows = []
        for text, own, following, next_own in zip(*(batch.column(c).to_pylist() for c in ("text", "fingerprint", "following", "next_own"))):
            rows.append((None, LAST, len(text), own, *compare(text, lz_phrases(text), own, following, next_own), None))
        yield _batch(batch.column("id").to_pylist(), rows, batch.schema.field("id").type)


def fingerprint_documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, n_chars, fingerprint, and the comparison with its edited text and the next one."""
    spark = df.sparkSession
    src = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    order = [F.col("id").desc_nulls_last(), F.xxhash64("text"), F.monotonically_increasing_id()]
    keyed = src.select("*", *[k.alias(f"k{i}") if i else F.col("id").alias("k0") for i, k in enumerate(order)])
    by = [F.col("k0").desc_nulls_last(), F.col("k1"), F.col("k2")]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = keyed.repartitionByRange(parts, *by).sortWithinPartitions(*by).select(
        F.spark_partition_id().alias("part"), "id", "text")
    id_type = src.schema["id"].dataType.simpleString()
    schema = f"id {id_type}, {_OUT}"
    rows = materialise(placed.mapInArrow(releasing(_scan), schema), "lz-rows")
    # the partition after each one; as many numbers as partitions
    used = sorted(r["part"] for r in rows.filter(F.col("place") == FIRST).select("part").collect())
    after = spark.createDataFrame([(p, used[(i + 1) % len(used)]) for i, p in enumerate(used)], "part int, next_part int")
    heads = rows.filter(F.col("place") == FIRST).select(
        F.col("part").alias("next_part"), F.col("text").alias("following"), F.col("fingerprint").alias("next_own"))
    last = rows.filter(F.col("place") == LAST).join(after, "part").join(heads, "next_part").select(
        "id", "text", "fingerprint", "following", "next_own").mapInArrow(releasing(_close), schema)
    done = rows.filter(F.col("place") == MIDDLE).unionByName(last)
    return done.select("id", "n_chars", "edited_sha256", F.lower(F.hex("fingerprint")).alias("fingerprint"),
                       F.lower(F.hex("edited_fingerprint")).alias("edited_fingerprint"), "near_edited", "near_next")
