"""Collocations of a corpus by weighted acyclic automata, built level by level.

* A shard is a run of texts of one language as word numbers.  Its count transducer at a
  level holds its phrases of that many words as sorted arcs (state of the words before the
  last, last word, count).  The states are those of the whole corpus's automaton, so each
  level only adds arcs to states that all shards share.
* The shards' arcs are united by prefix range, their weights summed.  Ranges are cut by the
  weight of the states, known from the level before, so each has as much to unite; a state
  with more weight than a range is cut by its last words.  Arcs of at least ``least``
  occurrences get the next level's states; the others end there, as no longer phrase can be
  frequent then.  The shards learn which of their arcs live on, and extend those alone.
* Part lookups compose the automaton with itself.  The counts of first parts are the weights
  along a phrase's own path.  Its rest is reached by its suffix state, which is the arc of
  its last word from the suffix state of its prefix; the path of that state has the weights
  of all shorter rests.

A very frequent phrase is one arc a shard.  A task holds one shard, or one range.

Defined cases: null and empty texts have no words; a null language is ``und``; repeated rows
and null ids each count; an empty table gives no rows.  Long texts are taken in sections
between words; their shard is as long as they are (four bytes a word).
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import broadcast_if_small, materialise
from .textarrays import mix64, releasing, releasing_groups

LEAST, LONGEST, TOP, COVER = 100, 5, 2000, 100
UNKNOWN_LANG = "und"
#: Words after which a task ends its shards, and bytes of text taken at once.
SHARD_WORDS = 1 << 20
SECTION_BYTES = 1 << 21
#: Rows of words, and occurrences of phrases, that a range unites.
RANGE_WORDS, RANGE_WEIGHT = 400_000, 2_000_000
#: States are numbered within their range.
_RANGE_BITS = 36
_BREAK = re.compile(rb"[.,;:!?\x0A-\x0D]")
_SCHEMA = "kind int, shard bigint, lang string, idx int, word string, n bigint, blob binary"
_STEP_SCHEMA = "kind int, shard bigint, cell bigint, base int, n int, blob binary"
_STEP = pa.schema([("kind", pa.int32()), ("shard", pa.int64()), ("cell", pa.int64()), ("base", pa.int32()), ("n", pa.int32()), ("blob", pa.binary())])
_UNITED_SCHEMA = "kind int, shard bigint, n int, blob binary, lang string, text string, state bigint, word bigint, f bigint, target bigint"
_UNITED = pa.schema([("kind", pa.int32()), ("shard", pa.int64()), ("n", pa.int32()), ("blob", pa.binary()), ("lang", pa.string()), ("text", pa.string()),
                     ("state", pa.int64()), ("word", pa.int64()), ("f", pa.int64()), ("target", pa.int64())])


def squeeze(*arrays: np.ndarray) -> bytes:
    """Equally long arrays of numbers from 0 as one zstd blob of byte planes."""
    table = np.stack(arrays).astype("<i8")
    return zstandard.ZstdCompressor(level=1).compress(table.view(np.uint8).reshape(-1, 8).T.tobytes())


def unsqueeze(blob: bytes, arrays: int) -> list[np.ndarray]:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompressobj().decompress(blob), np.uint8)
    return list(np.ascontiguousarray(raw.reshape(8, -1).T).view("<i8").reshape(arrays, -1))


def _batch(schema: pa.Schema, rows: int, /, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(rows, f.type) for f in schema], schema=schema)


class _Numbers(dict):
    """Words by the order in which they are first asked for, from 1."""

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self) + 1
        return n


class Shard:
    """Words of one language's texts as their numbers, 0 between pieces."""

    def __init__(self) -> None:
        self.number = _Numbers()
        self.parts: list[np.ndarray] = []
        self.size = 0

    def add(self, text: bytes) -> None:
        text, begin = text.lower(), 0  # A-Z only
        while begin < len(text):
            end = min(len(text), begin + SECTION_BYTES)
            while end < len(text) and text[end] not in b" \t":  # a word is never cut
                end += 1
            out: list[int] = []
            number = self.number
            for piece in _BREAK.split(text[begin:end]):
                out.extend(map(number.__getitem__, piece.split()))
                out.append(0)
            if end < len(text):
                out.pop()  # the piece goes on in the next section
            self.parts.append(np.array(out, np.int32))
            self.size += len(out)
            begin = end


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (lang, text) to the task's shards (kind 0) and their words with counts (kind 1)."""
    task, made = TaskContext.get().partitionId() << 24, 0
    schema = pa.schema([("kind", pa.int32()), ("shard", pa.int64()), ("lang", pa.string()), ("idx", pa.int32()),
                        ("word", pa.string()), ("n", pa.int64()), ("blob", pa.binary())])

    def flush(open_: dict[str, Shard]) -> Iterator[pa.RecordBatch]:
        nonlocal made
        for lang, shard in open_.items():
            seq = np.concatenate(shard.parts)
            places = np.flatnonzero(seq)
            arcs = seq[places].astype(np.int64)
            n, name = len(shard.number), task + made
            made += 1
            yield _batch(schema, 1, kind=[0], shard=[name], lang=[lang], n=[len(arcs)], blob=[squeeze(np.diff(places, prepend=0), arcs)])
            yield _batch(schema, n, kind=np.ones(n, np.int32), shard=np.full(n, name), lang=[lang] * n, idx=np.arange(1, n + 1, dtype=np.int32),
                         word=[w.decode("utf-8") for w in shard.number], n=np.bincount(arcs, minlength=n + 1)[1:])

    open_: dict[str, Shard] = {}
    held = 0
    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text")):
            shard = open_.setdefault(lang, Shard())
            held -= shard.size
            shard.add(text.as_buffer().to_pybytes())
            held += shard.size
            if held >= SHARD_WORDS:
                yield from flush({k: s for k, s in open_.items() if s.number})
                open_, held = {}, 0
    yield from flush({k: s for k, s in open_.items() if s.number})


def _alive(shard: np.ndarray, idx: np.ndarray, target: np.ndarray, word: np.ndarray, before: np.ndarray, f: np.ndarray) -> list[pa.RecordBatch]:
    """What each shard has to know of its arcs that live on, one row a shard."""
    order = np.lexsort((idx, shard))
    shard = shard[order]
    names, begin = np.unique(shard, return_index=True)
    ends = [*begin[1:].tolist(), len(shard)]
    idx, target, word, before, f = (x[order] for x in (idx, target, word, before, f))
    blobs = [squeeze(np.diff(idx[x:y], prepend=0), target[x:y], word[x:y], before[x:y], f[x:y]) for x, y in zip(begin.tolist(), ends)]
    return [_batch(_UNITED, len(names), kind=np.zeros(len(names), np.int32), shard=names, n=np.diff([0, *ends]), blob=blobs)]


def _unite_words(least: int):
    """One range of words: those frequent enough (kind 1) and what their shards have to know (kind 0)."""
    def run(table: pa.Table) -> pa.Table:
        cell = table.column("cell")[0].as_py()
        both = pa.table({"lang": table.column("lang"), "text": table.column("word"), "n": table.column("n")})
        sums = both.group_by(["lang", "text"]).aggregate([("n", "sum")])
        sums = sums.filter(pa.compute.greater_equal(sums.column("n_sum"), least)).sort_by([("lang", "ascending"), ("text", "ascending")])
        if not len(sums):
            return _UNITED.empty_table()
        f = sums.column("n_sum").to_numpy()
        target = (cell << _RANGE_BITS) + 1 + np.arange(len(f))
        number = {pair: i for i, pair in enumerate(zip(sums.column("lang").to_pylist(), sums.column("text").to_pylist()))}
        at = np.fromiter((number.get(pair, -1) for pair in zip(table.column("lang").to_pylist(), table.column("word").to_pylist())), np.int64, len(table))
        kept = at >= 0
        shard, idx, at = table.column("shard").to_numpy()[kept], table.column("idx").to_numpy()[kept].astype(np.int64), at[kept]
        before = np.cumsum(f) - f
        return pa.Table.from_batches([
            _batch(_UNITED, len(f), kind=np.ones(len(f), np.int32), lang=sums.column("lang").to_pylist(), text=sums.column("text").to_pylist(), f=f, target=target),
            *_alive(shard, idx, target[at], target[at], before[at], f[at])])
    return run


def _unite(least: int):
    """One prefix range: the shards' arcs with their weights summed, as :func:`_unite_words` does words."""
    def run(table: pa.Table) -> pa.Table:
        cell = table.column("cell")[0].as_py()
        parts = [unsqueeze(blob, 3) for blob in table.column("blob").to_pylist()]
        sizes = [len(p[0]) for p in parts]
        state, word, n = np.concatenate([np.cumsum(p[0]) for p in parts]), np.concatenate([p[1] for p in parts]), np.concatenate([p[2] for p in parts])
        shard = np.repeat(table.column("shard").to_numpy(), sizes)
        idx = np.concatenate([np.arange(b, b + k) for b, k in zip(table.column("base").to_pylist(), sizes)])
        del parts
        order = np.lexsort((word, state))
        state, word, n, shard, idx = (x[order] for x in (state, word, n, shard, idx))
        new = np.ones(len(state), bool)
        new[1:] = (state[1:] != state[:-1]) | (word[1:] != word[:-1])
        begin = np.flatnonzero(new)
        f = np.add.reduceat(n, begin)
        rank = np.cumsum(f >= least) - 1
        kept = np.repeat(f >= least, np.diff(np.append(begin, len(state))))
        if not kept.any():
            return _UNITED.empty_table()
        at = np.repeat(rank, np.diff(np.append(begin, len(state))))[kept]
        begin, f = begin[f >= least], f[f >= least]
        target, before = (cell << _RANGE_BITS) + 1 + np.arange(len(f)), np.cumsum(f) - f
        return pa.Table.from_batches([
            _batch(_UNITED, len(f), kind=np.ones(len(f), np.int32), state=state[begin], word=word[begin], f=f, target=target),
            *_alive(shard[kept], idx[kept], target[at], word[kept], before[at], f[at])])
    return run


def _share(words: np.ndarray) -> np.ndarray:
    """A place in [0, 1) for every word, by which the arcs of a heavy state are cut."""
    return (mix64(words.astype(np.uint64)) >> np.uint64(11)).astype(np.float64) / 2.0 ** 53


def _extend(weights: list[tuple[int, int]], cells: int):
    """Phrases of a shard whose arc lives on, extended by a word: the arcs of the next level by prefix range.

    ``weights``: the ranges of the level before, in order, and their weights.
    """
    ranges = np.array([r for r, _ in weights], np.int64)
    offsets = np.concatenate([[0.0], np.cumsum([w for _, w in weights], dtype=np.float64)])

    def run(shard: pa.Table, alive: pa.Table) -> pa.Table:
        if not len(shard) or not len(alive):
            return _STEP.empty_table()
        name = shard.column("shard")[0].as_py()
        places, arcs = unsqueeze(shard.column("blob")[0].as_py(), 2)
        places = np.cumsum(places)
        parts = [unsqueeze(blob, 5) for blob in alive.column("blob").to_pylist()]
        idx = np.concatenate([np.cumsum(p[0]) for p in parts])
        size = int(max(arcs.max(), idx.max())) + 1
        target, word, low, f = (np.zeros(size, np.int64) for _ in range(4))
        for own, k in ((target, 1), (word, 2), (low, 3), (f, 4)):
            own[idx] = np.concatenate([p[k] for p in parts])
        keep = target[arcs] > 0
        places, arcs = places[keep], arcs[keep]
        follows = np.flatnonzero(places[1:] == places[:-1] + 1)  # the phrase one word on is frequent too
        if not len(follows):
            return _STEP.empty_table()
        first, last = arcs[follows], word[arcs[follows + 1]]
        weight = offsets[np.searchsorted(ranges, target[first] >> _RANGE_BITS)] + low[first] + f[first] * _share(last)
        cell = np.minimum((weight * (cells / offsets[-1])).astype(np.int64), cells - 1)
        state = target[first]
        order = np.lexsort((last, state, cell))
        cell, state, last = cell[order], state[order], last[order]
        new = np.ones(len(state), bool)
        new[1:] = (state[1:] != state[:-1]) | (last[1:] != last[:-1])  # a state and word have one cell
        begin, own = np.flatnonzero(new), np.empty(len(order), np.int64)
        own[order] = np.cumsum(new) - 1
        n = np.diff(np.append(begin, len(state)))
        used, at = np.unique(cell[begin], return_index=True)
        ends = [*at[1:].tolist(), len(begin)]
        state, last = state[begin], last[begin]
        blobs = [squeeze(np.diff(state[x:y], prepend=0), last[x:y], n[x:y]) for x, y in zip(at.tolist(), ends)]
        return pa.Table.from_batches([
            _batch(_STEP, 1, kind=[0], shard=[name], blob=[squeeze(np.diff(places[follows], prepend=0), own)]),
            _batch(_STEP, len(used), kind=np.ones(len(used), np.int32), shard=np.full(len(used), name), cell=used, base=at, n=np.diff([*at.tolist(), len(begin)]),
                   blob=blobs)])
    return run


def count_automaton(df: DataFrame, lang_col: str = "lang", text_col: str = "text", least: int = LEAST,
                    longest: int = LONGEST) -> tuple[DataFrame, list[DataFrame]]:
    """``(lang, n)`` and the levels of the automaton.

    The first level is ``(lang, word, f, target)``; the others ``(state, word, f, target)``,
    state and word being targets of the level before and of the first level.
    """
    src = df.select(F.coalesce(F.col(lang_col).cast("string"), F.lit(UNKNOWN_LANG)).alias("lang"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    stored = materialise(src.mapInArrow(releasing(_shards), _SCHEMA), "phrase-shards")
    totals = stored.filter("kind = 0").groupBy("lang").agg(F.sum("n").alias("n"))
    words = stored.filter("kind = 1").select("shard", "lang", "idx", "word", "n")
    cells = -(-words.count() // RANGE_WORDS) or 1
    united = words.withColumn("cell", F.pmod(F.xxhash64("lang", "word"), F.lit(cells))).groupBy("cell").applyInArrow(
        releasing_groups(_unite_words(least)), _UNITED_SCHEMA)
    united = materialise(united, "phrase-words")
    shards, levels = stored.filter("kind = 0").select("shard", "blob"), []
    for m in range(1, longest + 1):
        found = united.filter("kind = 1")
        levels.append(found.select("lang", F.col("text").alias("word"), "f", "target") if m == 1 else found.select("state", "word", "f", "target"))
        if m == longest:
            break
        weights = found.groupBy(F.shiftright("target", _RANGE_BITS).alias("range")).agg(F.sum("f").alias("w")).collect()  # one number a range
        weights = sorted((r["range"], r["w"]) for r in weights)
        cells = -(-sum(w for _, w in weights) // RANGE_WEIGHT) or 1
        alive = united.filter("kind = 0").select(F.col("shard").alias("of"), F.col("blob").alias("arcs"))
        step = shards.groupBy("shard").cogroup(alive.select("of", F.col("arcs").alias("blob")).groupBy("of")).applyInArrow(
            releasing_groups(_extend(weights, cells)), _STEP_SCHEMA)
        step = materialise(step, f"phrase-step{m + 1}")
        shards = step.filter("kind = 0").select("shard", "blob")
        united = step.filter("kind = 1").select("shard", "cell", "base", "blob").groupBy("cell").applyInArrow(releasing_groups(_unite(least)), _UNITED_SCHEMA)
        united = materialise(united, f"phrase-level{m + 1}")
    return totals, levels


def compose(levels: list[DataFrame]) -> list[DataFrame]:
    """Per level ``(target, lang, phrase, last, f, prefix, link, firsts, rests)``.

    ``firsts[k - 1]`` counts the first k words, ``rests[k - 1]`` what follows them; ``link``
    is the state of the phrase without its first word.
    """
    none = F.array().cast("array<bigint>")
    nowhere = F.lit(None).cast("bigint")
    known = levels[0].select("target", "lang", F.col("word").alias("phrase"), F.col("word").alias("last"), "f", nowhere.alias("prefix"),
                             nowhere.alias("link"), none.alias("firsts"), none.alias("rests"))
    out = [known]
    for m, arcs in enumerate(levels[1:], 2):
        paths = known.select(F.col("target").alias("state"), "lang", "phrase", F.col("link").alias("back"), F.col("f").alias("first_f"), "firsts")
        grown = arcs.join(paths, "state")
        # where the last word leads from the prefix's own suffix state
        if m == 2:
            ends = known.select(F.col("target").alias("word"), F.col("target").alias("link"), "last", F.col("f").alias("rest_f"), "rests")
            grown = grown.join(ends, "word")
        else:
            ends = known.join(levels[m - 2].select("target", F.col("state").alias("back"), "word"), "target").select(
                "back", "word", F.col("target").alias("link"), "last", F.col("f").alias("rest_f"), "rests")
            grown = grown.join(ends, ["back", "word"])
        known = materialise(grown.select(
            "target", "lang", F.concat("phrase", F.lit(" "), "last").alias("phrase"), "last", "f", F.col("state").alias("prefix"), "link",
            F.concat("firsts", F.array("first_f")).alias("firsts"), F.concat(F.array("rest_f"), "rests").alias("rests")), f"phrase-composed{m}")
        out.append(known)
    return out


def _score(k: int, m: int) -> Column:
    wide = [F.col(c).cast("decimal(20,0)") for c in ("f", "n")]
    low = F.col("firsts")[k - 1].cast("decimal(19,0)") * F.col("rests")[k - 1].cast("decimal(19,0)")
    whole = F.call_function("div", wide[0] * wide[1] * F.lit(1000).cast("decimal(4,0)"), low)
    return F.struct(whole.alias("score"), F.lit(k).alias("k"), F.col("firsts")[k - 1].alias("l"), F.col("rests")[k - 1].alias("r"))


def mine_phrases(df: DataFrame, lang_col: str = "lang", text_col: str = "text", least: int = LEAST, longest: int = LONGEST,
                 top: int = TOP, cover: int = COVER) -> DataFrame:
    """The best ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score.

    Phrases that a longer one of at least ``cover`` percent of their count contains are left
    out; the next longer ones decide that, as they contain all longer ones' occurrences.
    """
    totals, levels = count_automaton(df, lang_col, text_col, least, longest)
    composed, n_langs, kept = compose(levels), totals.count(), None
    for m in range(2, longest + 1):
        own = composed[m - 1].select("target", "lang", "phrase", "f", "firsts", "rests")
        if m < longest:
            longer = composed[m].select("prefix", "link", "f", F.col("firsts")[m - 1].alias("of_prefix"), F.col("rests")[0].alias("of_link"))
            inside = longer.filter(100 * F.col("f") >= cover * F.col("of_prefix")).select(F.col("prefix").alias("target")).union(
                longer.filter(100 * F.col("f") >= cover * F.col("of_link")).select("link"))
            own = own.join(inside.distinct(), "target", "left_anti")
        scored = own.join(broadcast_if_small(totals, n_langs), "lang").withColumn("best", F.array_min(F.array(*[_score(k, m) for k in range(1, m)])))
        scored = scored.select("lang", "phrase", F.col("f").alias("a"), "best.l", "best.r", "n", F.col("best.score").cast("long").alias("score"))
        kept = scored if kept is None else kept.union(scored)
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    ranked = kept.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
