"""Removal of repeated passages with a logarithmic family of suffix arrays.

A byte goes if a ``length``-byte string that covers it also starts earlier (in id order,
or earlier in the same document).  Matches never cross documents.

* Suffixes are sampled at anchors that depend on the string alone (``suffix_anchors``),
  so two equal strings always meet at equal anchors: a level is a sparse suffix array,
  its entries (hash of the suffix's first bytes, hash of the anchor's span, place)
  sorted and split into buckets by the first hash.
* The documents come in batches, in id order.  A batch's array is merge-scanned with
  the entries of every level.  An entry whose span occurs earlier is wholly repeated.
  Entries that share a suffix start but not the span are the edges of matches.
* As in a binary counter, the batch's array merges with the levels of its size into the
  next larger level, in the same scan.  Repeated spans do not enter a level, and each
  map task drops its own first, so a passage in very many documents costs one entry a
  task, not one a document.
* Edges are settled exactly: the bytes around them are fetched, all their strings are
  hashed, and a string that occurs earlier marks its bytes.  A suffix start shared by
  very many edges is split by string instead of being held by one task.

Exact copies of a text are classed by a 128-bit digest first and never enter an array.  A
span is known by 64 bits of its own and 50 bits of its first bytes' hash, a string by 64
bits within the strings that share a suffix start.

A text longer than ``SECTION_BYTES`` enters as sections that overlap by ``length - 1`` bytes, so
that every string lies in exactly one; sections follow each other in rank, and their
removed ranges are joined per text.

Defined cases: null and empty texts have nothing to remove; texts under ``length`` bytes
are kept whole; of equal ids the order is by text hash, and rows equal in
id and text count as one document (they get the same result); null ids come last; later copies
of a text of at least ``length`` bytes lose all of it; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import broadcast_if_small, materialise
from .suffix_anchors import PLACE_BITS, anchors
from .textarrays import CHUNK_ROWS, chunks, mix64, prefix_hash, releasing, releasing_groups, span_hash

LENGTH = 100
BATCHES = 3
#: Bytes of a text that enter an array as one (each takes some 150 bytes of memory for a moment).
SECTION_BYTES = 1 << 20
#: Bytes whose anchors are taken at once.
ANCHOR_BYTES = 1 << 17
#: Bytes of texts whose entries share a bucket, and edges that one task settles at once.
BUCKET_BYTES, GROUP_EDGES = 4 << 20, 600
#: Edges of one suffix start that one task may hold; beyond, they are split by string.
HOT_EDGES = 20_000
#: Entries that a map task sorts at once.
RUN_ENTRIES = 400_000
_REACH = np.uint64((1 << 14) - 1)  # low bits of the first hash hold how far the anchor's strings reach
_PLACE = (1 << PLACE_BITS) - 1


def pack(entries: np.ndarray) -> bytes:
    """Entries (n x 3 numbers) as compressed byte planes."""
    return zlib.compress(np.ascontiguousarray(entries.view(np.uint8).reshape(len(entries), 24).T).tobytes(), 1)


def unpack(blob: bytes) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(blob), np.uint8).reshape(24, -1)
    return np.ascontiguousarray(planes.T).view(np.uint64).reshape(-1, 3)


def sort_entries(entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Entries in suffix order; where a new suffix start begins; where a new span begins."""
    start = entries[:, 0] & ~_REACH
    order = np.lexsort((entries[:, 2], entries[:, 1], start))
    entries, start = entries[order], start[order]
    new_start, new_span = np.ones(len(entries), bool), np.ones(len(entries), bool)
    new_start[1:] = start[1:] != start[:-1]
    new_span[1:] = new_start[1:] | (entries[1:, 1] != entries[:-1, 1])
    return entries, new_start, new_span


_KINDS = pa.schema([("kind", pa.int32()), ("first_hash", pa.int64()), ("place", pa.int64()), ("reach", pa.int32()),
                    ("bucket", pa.int32()), ("blob", pa.binary())])
_SCHEMA = "kind int, first_hash bigint, place bigint, reach int, bucket int, blob binary"
REPEATED, EDGE, RUN = 0, 1, 2


def _entry_rows(kind: int, entries: np.ndarray) -> pa.RecordBatch:
    n = len(entries)
    return pa.RecordBatch.from_arrays([
        pa.array(np.full(n, kind, np.int32)), pa.array((entries[:, 0] & ~_REACH).view(np.int64)), pa.array(entries[:, 2].astype(np.int64)),
        pa.array((entries[:, 0] & _REACH).astype(np.int32)), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())], schema=_KINDS)


def _run_rows(buckets: list[int], blobs: list[bytes]) -> pa.RecordBatch:
    n = len(buckets)
    return pa.RecordBatch.from_arrays([
        pa.array(np.full(n, RUN, np.int32)), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int32()),
        pa.array(buckets, pa.int32()), pa.array(blobs, pa.binary())], schema=_KINDS)


def _map_runs(length: int, buckets: int):
    """Rows (rank, text) to one sorted run per bucket, and the entries that repeat inside the task."""
    def flush(parts: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        entries, _, new_span = sort_entries(np.concatenate(parts))
        # the same place twice is the same row twice, not an earlier string
        again = np.zeros(len(entries), bool)
        again[1:] = ~new_span[1:] & (entries[1:, 2] == entries[:-1, 2])
        yield _entry_rows(REPEATED, entries[~new_span & ~again])
        entries = entries[new_span]
        bucket = ((entries[:, 0] >> np.uint64(20)) % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        entries, bucket = entries[order], bucket[order]
        used, begin = np.unique(bucket, return_index=True)
        yield _run_rows(used.tolist(), [pack(part) for part in np.split(entries, begin[1:])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for batch in batches:
            ranks = batch.column(0).to_numpy().astype(np.uint64)
            for first, _, data, offsets in chunks(batch.column(1), ANCHOR_BYTES):
                a = anchors(data, offsets, length)
                reach = ((a["at"] - a["lo"]) << 7 | (a["at"] - a["hi"])).astype(np.uint64)
                place = ranks[first + a["row"]] << np.uint64(PLACE_BITS) | a["at"].astype(np.uint64)
                parts.append(np.stack([(a["gram"] & ~_REACH) | reach, a["span"], place], axis=1))
                held += len(parts[-1])
                if held >= RUN_ENTRIES:
                    yield from flush(parts)
                    parts, held = [], 0
        if held:
            yield from flush(parts)
    return run


def _scan(table: pa.Table) -> pa.Table:
    """One bucket: the new batch's runs against the levels'; gives repeats, edges and the merged run."""
    bucket, new, merge, parts = table.column("bucket")[0].as_py(), [], [], []
    for is_new, merges, blob in zip(*(table.column(c).to_pylist() for c in ("is_new", "merges", "blob"))):
        part = unpack(blob)
        parts.append(part)
        new.append(np.full(len(part), is_new))
        merge.append(np.full(len(part), merges))
    entries = np.concatenate(parts)
    # the source flags travel through the sort as a permutation of the same keys
    order = np.lexsort((entries[:, 2], entries[:, 1], entries[:, 0] & ~_REACH))
    new, merge = np.concatenate(new)[order], np.concatenate(merge)[order]
    entries, new_start, new_span = sort_entries(entries)
    again = np.zeros(len(entries), bool)
    again[1:] = ~new_span[1:] & (entries[1:, 2] == entries[:-1, 2])
    out = [_entry_rows(REPEATED, entries[~new_span & ~again & new])]
    group = np.cumsum(new_start) - 1
    spans, fresh = np.bincount(group, new_span), np.bincount(group, new_span & new)
    edge = new_span & (spans[group] > 1) & (fresh[group] > 0)
    out.append(_entry_rows(EDGE, entries[edge]))
    kept = new_span & merge
    if kept.any():
        out.append(_run_rows([bucket], [pack(entries[kept])]))
    return pa.Table.from_batches(out, schema=_KINDS)


def _contexts(length: int):
    """Rows (rank, text, edges) to one row per edge with the bytes of its strings."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(lo, CHUNK_ROWS) for b in batches for lo in range(0, len(b), CHUNK_ROWS)):
            hashes, places, befores, texts = [], [], [], []
            for rank, text, edges in zip(batch.column("rank").to_pylist(), batch.column("text"), batch.column("edges").to_pylist()):
                data = text.as_buffer().to_pybytes()
                for e in edges:
                    before, after = e["reach"] >> 7, e["reach"] & 127
                    lo, hi = e["at"] - before, e["at"] - after
                    hashes.append(e["first_hash"])
                    places.append(rank << PLACE_BITS | lo)
                    befores.append(before)
                    texts.append(data[lo:hi + length])
            yield pa.RecordBatch.from_arrays([pa.array(hashes, pa.int64()), pa.array(places, pa.int64()),
                                              pa.array(befores, pa.int32()), pa.array(texts, pa.binary())],
                                             ["first_hash", "place", "before", "bytes"])
    return run


def _string_hashes(table, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash and place of every string of the rows' bytes, and the row of each."""
    column = table.column("bytes")
    column = (column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column).cast(pa.large_binary())
    sizes = np.diff(np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1])
    data = np.frombuffer(b"".join(column.to_pylist()), np.uint8)
    ends = np.cumsum(sizes)
    counts = sizes - length + 1
    row = np.repeat(np.arange(len(sizes)), counts)
    within = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
    starts = (ends - sizes)[row] + within
    prefix = prefix_hash(data)
    # the offset of the anchor inside the string is part of its identity, as is the suffix start
    before = table.column("before").to_numpy()[row] - within
    own = mix64(table.column("first_hash").to_numpy().view(np.uint64)[row] + before.astype(np.uint64))
    return mix64(span_hash(prefix, starts, starts + length) ^ own), table.column("place").to_numpy()[row] + within, row


def _ranges(places: np.ndarray, length: int) -> pa.RecordBatch:
    """Sorted places of repeated strings as byte ranges (rank, from, to), neighbours joined."""
    places = np.sort(places)
    new = np.ones(len(places), bool)
    new[1:] = places[1:] != places[:-1] + 1
    begin = np.flatnonzero(new)
    end = np.append(begin[1:], len(places)) - 1
    first, last = places[begin], places[end] if len(places) else places
    return pa.RecordBatch.from_arrays([pa.array(first >> PLACE_BITS), pa.array((first & _PLACE).astype(np.int32)),
                                       pa.array(((last & _PLACE) + length).astype(np.int32))], ["rank", "lo", "hi"])


def _settle(length: int):
    """All edges of one group of suffix starts: every string but the first of its kind is repeated."""
    def run(table: pa.Table) -> pa.Table:
        hashes, places, _ = _string_hashes(table, length)
        order = np.lexsort((places, hashes))
        hashes, places = hashes[order], places[order]
        first = np.ones(len(hashes), bool)
        first[1:] = hashes[1:] != hashes[:-1]
        least = places[np.maximum.accumulate(np.where(first, np.arange(len(hashes)), 0))]
        return pa.Table.from_batches([_ranges(places[places != least], length)])
    return run


def _strings(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes, places, _ = _string_hashes(batch, length)
            yield pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64)), pa.array(places)], ["string", "place"])
    return run


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (text_key, text, ranges) without the bytes of their ranges."""
    for batch in (b.slice(lo, CHUNK_ROWS) for b in batches for lo in range(0, len(b), CHUNK_ROWS)):
        removed, spans, digests, texts = [], [], [], []
        for text, ranges in zip(batch.column("text"), batch.column("ranges").to_pylist()):
            data, out, at, gone, count = text.as_buffer().to_pybytes(), [], 0, 0, 0
            for r in sorted((r["lo"], r["hi"]) for r in ranges):
                if r[0] > at or not count:
                    out.append(data[at:r[0]])
                    count += 1
                    gone += r[1] - r[0]
                    at = r[1]
                elif r[1] > at:
                    gone += r[1] - at
                    at = r[1]
            out.append(data[at:])
            kept = b"".join(out)
            removed.append(gone)
            spans.append(count)
            digests.append(hashlib.sha256(kept).hexdigest())
            texts.append(kept.decode("utf-8", "ignore"))
        yield pa.RecordBatch.from_arrays([batch.column("text_key"), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()),
                                          pa.array(digests, pa.string()), pa.array(texts, pa.string())],
                                         ["text_key", "n_removed", "n_spans", "kept_sha256", "kept_text"])


class SuffixIndex:
    """The levels of a corpus: tables of runs, level ``i`` made of ``2**i`` batches."""

    def __init__(self, buckets: int, length: int = LENGTH):
        self.buckets, self.length, self.added = buckets, length, 0
        self.levels: dict[int, DataFrame] = {}

    def add(self, batch: DataFrame) -> DataFrame:
        """Scan a batch (rank, text), all of it after the batches before; rows of repeats and edges."""
        grown = 0
        while grown in self.levels:
            grown += 1
        mapped = materialise(batch.mapInArrow(releasing(_map_runs(self.length, self.buckets)), _SCHEMA), "suffix-runs")
        inputs = mapped.filter(F.col("kind") == RUN).select("bucket", "blob", F.lit(True).alias("is_new"), F.lit(True).alias("merges"))
        for i, level in self.levels.items():
            inputs = inputs.union(level.select("bucket", "blob", F.lit(False), F.lit(i < grown)))
        scanned = materialise(inputs.groupBy("bucket").applyInArrow(releasing_groups(_scan), _SCHEMA), "suffix-scan")
        self.levels = {i: level for i, level in self.levels.items() if i > grown}
        self.levels[grown] = scanned.filter(F.col("kind") == RUN)
        self.added += 1
        return mapped.unionByName(scanned).filter(F.col("kind") != RUN).drop("bucket", "blob")


def _ranked(rows: DataFrame, length: int) -> DataFrame:
    """Sections of the first row of each distinct text, ``(text_key, id, n_bytes, section, rank)``; ranks are dense in order of id and section."""
    firsts = rows.groupBy("text_key").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id")).alias("m"), F.first("n_bytes").alias("n_bytes"))
    step = SECTION_BYTES - (length - 1)
    last = F.greatest(F.lit(0), F.ceil((F.col("n_bytes") - (length - 1)) / step) - 1).cast("int")
    firsts = firsts.select("text_key", "m.none", "m.id", "n_bytes", F.explode(F.sequence(F.lit(0), last)).alias("section"))
    order = [F.col("none"), F.col("id"), F.col("text_key"), F.col("section")]
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = firsts.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    ordered = materialise(ordered.select("text_key", "id", "n_bytes", "section", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("mono")),
                          "suffix-firsts")
    counts = sorted((r["part"], r["n"], r["m"]) for r in ordered.groupBy("part").agg(F.count("*").alias("n"), F.min("mono").alias("m")).collect())
    shift, total = [], 0
    for part, n, least in counts:  # as many numbers as partitions
        shift.append((part, total - least))
        total += n
    offsets = rows.sparkSession.createDataFrame(shift, "part int, shift bigint")
    return ordered.join(F.broadcast(offsets), "part").select("text_key", "id", "n_bytes", "section", (F.col("mono") + F.col("shift")).alias("rank"))


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, batches: int = BATCHES,
                   hot_edges: int = HOT_EDGES, carry: tuple[str, ...] = (), with_text: bool = False) -> DataFrame:
    """One row per document: id, n_bytes, n_removed, n_spans, kept_sha256, ``carry_<name>`` columns.

    ``with_text`` adds ``kept_text``; a character of which only some bytes are left is dropped there.
    """
    spark = df.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = df.select(F.col(id_col).alias("id"), text.alias("text"), F.unhex(F.md5(text)).alias("text_key"),
                     F.octet_length(text).cast("long").alias("n_bytes"), *[F.col(c).alias(f"carry_{c}") for c in carry])
    firsts = materialise(_ranked(rows.select("id", "text_key", "n_bytes"), length), "suffix-ranks")
    long_enough = firsts.filter(F.col("n_bytes") >= length)
    size = firsts.agg(F.count("*").alias("n"), F.sum(F.least("n_bytes", F.lit(SECTION_BYTES))).alias("bytes"), F.max("section").alias("sections")).first()
    total, step = size["n"], SECTION_BYTES - (length - 1)

    def texts(wanted: DataFrame, n: int | None = None) -> DataFrame:
        """(rank, text_key, text) of the sections in ``wanted`` (with text_key, id, section, rank), as bytes."""
        side = broadcast_if_small(wanted.select("text_key", "rank", "section", F.col("id").alias("first_id")), n)
        found = rows.select("id", "text_key", "text").join(side, "text_key").filter(F.col("id").eqNullSafe(F.col("first_id")))
        data = F.col("text").cast("binary")
        part = F.when(F.octet_length("text") <= SECTION_BYTES, data).otherwise(F.substring(data, F.col("section") * step + 1, F.lit(SECTION_BYTES)))
        return found.select("rank", "text_key", part.alias("text"))

    index, found = SuffixIndex(-(-(size["bytes"] or 0) // BUCKET_BYTES) or 1, length), []
    for b in range(batches):
        lo, hi = total * b // batches, total * (b + 1) // batches
        if hi > lo:
            found.append(index.add(texts(long_enough.filter((F.col("rank") >= lo) & (F.col("rank") < hi))).select("rank", "text")))
    places = found[0] if found else spark.createDataFrame([], "kind int, first_hash bigint, place bigint, reach int")
    for more in found[1:]:
        places = places.unionByName(more)
    places = places.withColumn("rank", F.shiftright("place", PLACE_BITS)).withColumn("at", F.col("place").bitwiseAND(_PLACE).cast("int"))
    before, after = F.shiftright("reach", 7), F.col("reach").bitwiseAND(127)
    repeated = places.filter(F.col("kind") == REPEATED).select(
        "rank", (F.col("at") - before).alias("lo"), (F.col("at") - after + length).alias("hi"))

    edges = places.filter(F.col("kind") == EDGE).dropDuplicates(["place"])
    per_document = materialise(edges.groupBy("rank").agg(F.collect_list(F.struct("first_hash", "at", "reach")).alias("edges")), "suffix-edges")
    held = texts(long_enough.join(broadcast_if_small(per_document.select("rank")), "rank", "left_semi")).dropDuplicates(["rank"])
    contexts = materialise(held.join(per_document, "rank").select("rank", "text", "edges").mapInArrow(
        releasing(_contexts(length)), "first_hash bigint, place bigint, before int, bytes binary"), "suffix-contexts")
    sizes = contexts.groupBy("first_hash").agg(F.count("*").alias("n")).filter(F.col("n") > hot_edges).select("first_hash")
    hot = materialise(sizes, "suffix-hot")
    n_hot = hot.count()
    usual = contexts if not n_hot else contexts.join(broadcast_if_small(hot, n_hot), "first_hash", "left_anti")
    groups = -(-contexts.count() // GROUP_EDGES) or 1
    settled = usual.withColumn("grp", F.pmod(F.xxhash64("first_hash"), F.lit(groups))).groupBy("grp").applyInArrow(
        releasing_groups(_settle(length)), "rank bigint, lo int, hi int")
    ranges = repeated.unionByName(settled)
    if n_hot:
        strings = contexts.join(broadcast_if_small(hot, n_hot), "first_hash", "left_semi").mapInArrow(
            releasing(_strings(length)), "string bigint, place bigint")
        strings = materialise(strings, "suffix-strings")
        least = strings.groupBy("string").agg(F.min("place").alias("least"), F.count("*").alias("n")).filter("n > 1").drop("n")
        later = strings.join(least, "string").filter(F.col("place") != F.col("least"))
        at = F.col("place").bitwiseAND(_PLACE).cast("int")
        ranges = ranges.unionByName(later.select(F.shiftright("place", PLACE_BITS).alias("rank"), at.alias("lo"), (at + length).alias("hi")))
    per_rank = ranges.groupBy("rank").agg(F.collect_set(F.struct("lo", "hi")).alias("ranges"))
    at = F.col("section") * step
    whole = long_enough.select("rank", "text_key", F.col("id").alias("first_id"), "section").join(per_rank, "rank").select(
        "text_key", "first_id", F.transform("ranges", lambda r: F.struct((r["lo"] + at).alias("lo"), (r["hi"] + at).alias("hi"))).alias("ranges"))
    if size["sections"]:  # the sections of a text are its own, so a row holds no more than one text
        whole = whole.groupBy("text_key", "first_id").agg(F.flatten(F.collect_list("ranges")).alias("ranges"))
    whole = materialise(whole, "suffix-removed")
    touched = rows.select("id", "text_key", "text").join(broadcast_if_small(whole.select("text_key", "first_id")), "text_key")
    touched = touched.filter(F.col("id").eqNullSafe(F.col("first_id"))).dropDuplicates(["text_key"]).select("text_key", "text")
    cut = touched.join(whole.drop("first_id"), "text_key").select("text_key", "text", "ranges").mapInArrow(
        releasing(_cut), "text_key binary, n_removed bigint, n_spans bigint, kept_sha256 string, kept_text string")
    cut = materialise(cut if with_text else cut.drop("kept_text"), "suffix-cut")

    plan = firsts.filter("section = 0").select("text_key", F.col("id").alias("first_id")).join(cut, "text_key", "left")
    if not with_text:
        plan = broadcast_if_small(plan, total)
    out = rows.join(plan, "text_key")
    is_first = F.col("id").eqNullSafe(F.col("first_id"))
    copy = ~is_first & (F.col("n_bytes") >= length)
    nothing = F.sha2(F.lit(""), 256)
    result = [
        "id", "n_bytes", F.when(copy, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(copy, 1).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(copy, nothing).otherwise(F.coalesce("kept_sha256", F.sha2("text", 256))).alias("kept_sha256"),
        *[f"carry_{c}" for c in carry]]
    if with_text:
        result.append(F.when(copy, "").otherwise(F.coalesce("kept_text", "text")).alias("kept_text"))
    return out.select(*result)

