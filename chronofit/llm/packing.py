"""Best-fit packing of tokenised documents by bin completion.

Documents are tokenised in Arrow batches.  The tokenizer never joins characters across
ASCII white space, nor a letter and a mark, so a text's ids are those of its units in a
row; each task keeps a bounded cache of units it has encoded.  A document over ``capacity`` tokens is cut into
full pieces and a rest; full pieces are sequences of their own.

The other pieces are dealt at random to groups of about ``GROUP_PIECES``, and each group
is packed by itself: best-fit decreasing gives the incumbent; if it uses more sequences
than the lower bound, bin completion searches on.  It takes the largest piece left,
enumerates the undominated fillings around it (fullest first), and abandons a branch
when the waste so far rules out a better packing.  A group wastes less than one sequence
more than a global packing would, under 0.1 % at this group size.  Only lengths
travel to the groups, no text.

Defined cases: a null or empty text is the one end token; repeated rows are packed each;
null ids are kept; an empty table gives no rows.
"""

from __future__ import annotations

import os
import re
import zlib
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise
from .textarrays import chunks, distinct_spans, kept_between_tasks, releasing, releasing_groups

CAPACITY = 2048
END_ID = 0
GROUP_PIECES = 8192
#: Bin completion gives up and keeps its incumbent after so many steps (a step takes or leaves
#: one size), and so many more per sequence of the incumbent.
STEPS, STEPS_PER_BIN = 1_000_000, 500
#: With up to so many sizes left, a branch is also ended by the sum of the smaller pieces.
_SUMMED = 128
#: Numbers of pieces that are enumerated together, fewest first.
_PIECES = ((0, 2), (3, 4), (5, 1 << 30))
#: Steps of a band's first turn.
_TURN = 4096
#: Units that a task remembers, and how many bytes of them.
CACHE_UNITS, CACHE_BYTES = 400_000, 48 << 20
#: Marks that start a unit behind a letter or digit (none of them part of a contraction).
_MARKS = b".,;:!?*$%&#"
#: Units of these letters alone are one pre-token each, whose last id ends a word.
_PLAIN = re.compile("[a-z\u00df-\u00f6\u00f8-\u00ff]+")
_JOINED = 512
_SPACE, _MARK, _ALNUM = (np.array([c in kind for c in range(256)]) for kind in (b" \t\n\x0b\x0c\r", _MARKS, b"0123456789abcdefghijklmnopqrstuvwxyz"))


class WordIds:
    """Ids of the units of texts: words at ASCII white space, and what follows a letter or digit from a mark on.

    The tokenizer always splits there, so a text's ids are those of its units in a row.
    Number 0 is the end of a document.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        vocabulary = self.tokenizer.get_vocab()
        self.ends_word = np.zeros(1 + max(vocabulary.values()), bool)
        self.ends_word[[i for entry, i in vocabulary.items() if entry.endswith("</w>")]] = True
        self.clear()

    def clear(self) -> None:
        self.number: dict[bytes, int] = {}
        self.held = 0
        self.ids = np.array([END_ID], np.uint32)
        self.ends = np.array([0, 1], np.int64)

    def _learn(self, units: list[bytes]) -> None:
        texts = {u: u.decode("utf-8") for u in units}
        plain = [u for u, t in texts.items() if _PLAIN.fullmatch(t.lower())]
        order, ids, ends, single = [], [], [], list(texts.keys() - plain)
        at = int(self.ends[-1])
        for lo in range(0, len(plain), _JOINED):
            own = plain[lo:lo + _JOINED]
            part = np.array(self.tokenizer.encode(" ".join(map(texts.__getitem__, own)), add_special_tokens=False).ids, np.uint32)
            cuts = np.flatnonzero(self.ends_word[part]) + 1
            if len(cuts) != len(own):  # a word that is not one pre-token after all
                single += own
                continue
            order += own
            ids.append(part)
            ends.append(at + cuts)
            at += len(part)
        for u, e in zip(single, self.tokenizer.encode_batch([texts[u] for u in single], add_special_tokens=False)):
            order.append(u)
            ids.append(np.array(e.ids, np.uint32))
            at += len(e.ids)
            ends.append(np.array([at]))
        n = len(self.ends) - 1
        self.number.update(zip(order, range(n, n + len(order))))
        self.held += sum(map(len, order))
        self.ids = np.concatenate([self.ids, *ids])
        self.ends = np.concatenate([self.ends, *ends])

    def of(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the rows of a chunk, each with the end's behind it, and where the rows start."""
        data = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)
        n_rows = len(offsets) - 1
        if len(data):
            space = _SPACE[data]
            new = ~space
            new[1:] &= space[:-1] | (_MARK[data[1:]] & _ALNUM[data[:-1]])
            edge = offsets[:-1][offsets[:-1] < len(data)]
            new[edge] |= ~space[edge]
            starts = np.flatnonzero(new)
            stops = np.append(np.flatnonzero(space), len(data))
            limits = np.append(starts[1:], len(data)) if len(starts) else starts
            ends = np.minimum(np.minimum(limits, stops[np.searchsorted(stops, starts)]), offsets[np.searchsorted(offsets, starts, "right")])
            one, kind = distinct_spans(data, starts, ends)
            raw = data.tobytes()
            units = [raw[x:y] for x, y in zip(starts[one].tolist(), ends[one].tolist())]
            row = np.searchsorted(offsets, starts, "right") - 1
        else:
            units, row = [], np.zeros(0, np.int64)
            kind = row
        fresh = [u for u in units if u not in self.number]
        if fresh:
            if len(self.number) + len(fresh) > CACHE_UNITS or self.held > CACHE_BYTES:
                self.clear()
                fresh = units
            self._learn(fresh)
        number = np.fromiter(map(self.number.__getitem__, units), np.int64, len(units))[kind]
        counts = np.bincount(row, minlength=n_rows)
        number = np.insert(number, np.cumsum(counts), 0)
        begin = self.ends[number]
        size = self.ends[number + 1] - begin
        total = np.cumsum(size)
        ids = self.ids[np.arange(total[-1] if len(total) else 0) + np.repeat(begin - total + size, size)]
        return ids, np.concatenate([[0], total[np.cumsum(counts + 1) - 1]]) if n_rows else np.zeros(1, np.int64)


_workers: dict[str, WordIds] = kept_between_tasks(__name__)


def word_ids(path: str) -> WordIds:
    if path not in _workers:
        _workers[path] = WordIds(path)
    return _workers[path]


def encode(path: str, texts: list[bytes]) -> Iterator[bytes]:
    """Ids of each UTF-8 text, as little-endian 32-bit numbers, without special tokens."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    ids, at = word_ids(path).of(data, np.cumsum([0, *map(len, texts)]))
    for x, y in zip(at.tolist(), at.tolist()[1:]):
        yield ids[x:y - 1].astype("<u4").tobytes()


def _pieces(path: str, capacity: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, stop, data, offsets in chunks(batch.column("text")):
                ids, at = word_ids(path).of(data, offsets)
                raw, ids = ids.astype("<u4").tobytes(), ids if with_ids else None
                sizes = np.diff(at)
                pieces = -(-sizes // capacity)
                owner = np.repeat(np.arange(len(sizes)), pieces)
                number = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                start = number * capacity
                length = np.minimum(sizes[owner] - start, capacity)
                low = ((at[owner] + start) * 4).tolist()
                crc = [zlib.crc32(raw[x:x + 4 * n]) for x, n in zip(low, length.tolist())]
                lists = [ids[x // 4:x // 4 + n].astype(np.int64).tolist() for x, n in zip(low, length.tolist())] if with_ids else [None] * len(owner)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").take(pa.array(first + owner)), pa.array(number, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()),
                     pa.array(crc, pa.int64()), pa.array(lists, pa.list_(pa.int64()))], ["id", "piece", "start", "length", "ids_crc32", "ids"])
    return run


def best_fit_decreasing(lengths: list[int], capacity: int) -> list[list[int]]:
    """Bins as lists of lengths; each length goes to the fullest bin that still takes it."""
    open_: dict[int, list[list[int]]] = {}
    rooms: list[int] = []
    bins: list[list[int]] = []
    for x in sorted(lengths, reverse=True):
        i = bisect_left(rooms, x)
        if i < len(rooms):
            room = rooms[i]
            own = open_[room].pop()
            if not open_[room]:
                rooms.pop(i)
        else:
            room, own = capacity, []
            bins.append(own)
        own.append(x)
        if room - x:
            if not open_.setdefault(room - x, []):
                insort(rooms, room - x)
            open_[room - x].append(own)
    return bins


def lower_bound(lengths: list[int], capacity: int) -> int:
    """Martello and Toth's L2: large pieces need bins of their own, middle ones fill what is left."""
    values = np.sort(np.array(lengths, np.int64))
    total = np.concatenate([[0], np.cumsum(values)])
    best = -(-int(total[-1]) // capacity)
    for k in np.unique(values[values <= capacity // 2]).tolist() + [0]:
        half, big, low = (int(np.searchsorted(values, v, "right")) for v in (capacity // 2, capacity - k, k - 1))
        middle = int(total[half] - total[low]) - ((len(values) - half - (len(values) - big)) * capacity - int(total[big] - total[half]))
        best = max(best, len(values) - half + max(0, -(-middle // capacity)))
    return best


class Search:
    """The pieces left of a group, by size, and the steps that a search may still take."""

    def __init__(self, lengths: list[int], steps: int):
        self.counts: dict[int, int] = {}
        for x in lengths:
            self.counts[x] = self.counts.get(x, 0) + 1
        self.sizes = sorted(self.counts)
        self.steps = steps

    def take(self, x: int) -> None:
        self.counts[x] -= 1
        if not self.counts[x]:
            self.sizes.pop(bisect_left(self.sizes, x))

    def put(self, x: int) -> None:
        if not self.counts[x]:
            insort(self.sizes, x)
        self.counts[x] += 1

    def fillings(self, room: int, waste: int, fair: int = 0) -> Iterator[tuple[int, ...]]:
        """Every undominated set of pieces that leaves at most ``waste`` of ``room``, lazily.

        Sets are found by taking or leaving the largest size that fits, depth first, in bands of
        growing slack, and by their number of pieces, so the fullest with few pieces come first (the first band reaches to ``fair``, what every
        sequence may waste); a branch ends where the smaller pieces cannot fill enough.  A band that finds nothing for a while waits until the wider ones have
        had as long, with twice the time from turn to turn.  Each decision is a step; without
        steps left the enumeration ends early.  The pieces must be as they were whenever the
        next set is asked for.
        """
        sizes, counts = self.sizes[:bisect_right(self.sizes, room)], self.counts
        smaller = [0, *accumulate(x * counts[x] for x in sizes)] if len(sizes) <= _SUMMED else None
        bands, low, high = [], 0, fair
        while low <= waste:
            bands += [(low, min(high, waste), least, most, [(len(sizes) - 1, room, ())]) for least, most in _PIECES]
            low, high = high + 1, 2 * high + 2
        turn = _TURN
        while bands and self.steps > 0:
            for low, high, least, most, stack in bands:
                idle = 0
                while stack and self.steps > 0 and idle < turn:
                    i, left, chosen = stack.pop()
                    self.steps -= 1
                    idle += 1
                    i = min(i, bisect_right(sizes, left) - 1)
                    if i < 0 or len(chosen) == most:
                        if low <= left <= high and len(chosen) >= least and self._undominated(sizes, chosen, left):
                            idle = 0
                            yield chosen
                        continue
                    if smaller is not None and left - smaller[i + 1] > high:
                        continue
                    x = sizes[i]
                    if left - (most - len(chosen)) * x > high:
                        continue
                    stack.append((i - 1, left, chosen))
                    if counts[x] > (chosen.count(x) if chosen and chosen[-1] == x else 0):
                        stack.append((i, left - x, (*chosen, x)))
            bands = [band for band in bands if band[-1]]
            turn *= 2

    def _undominated(self, sizes: list[int], chosen: tuple[int, ...], left: int) -> bool:
        """Whether no unused piece could be added, or take the place of a smaller one.

        Such a set with the larger piece is never worse: the piece it sets free fits wherever
        the larger one would have gone.
        """
        for x in {0, *chosen} if left else ():
            for j in range(bisect_right(sizes, x), bisect_right(sizes, x + left)):
                if self.counts[sizes[j]] > chosen.count(sizes[j]):
                    return False
        return True


def bin_completion(lengths: list[int], capacity: int) -> list[list[int]]:
    """Bins of lengths by depth-first branch and bound with best-fit decreasing as first incumbent."""
    best = best_fit_decreasing(lengths, capacity)
    bound = lower_bound(lengths, capacity)
    if len(best) <= bound:
        return best
    search = Search(lengths, STEPS + STEPS_PER_BIN * len(best))
    sizes, take, put, total = search.sizes, search.take, search.put, sum(lengths)
    stack: list[list] = []  # per open bin: its largest piece, fillings left to try, filling in use, waste above it
    waste, done, down = 0, False, True
    while search.steps > 0 and not done:
        if down:
            if not sizes:
                best = [[s[0], *s[2]] for s in stack]
                done, down = len(best) <= bound, False
                continue
            top = sizes[-1]
            take(top)
            spare = (len(best) - 1) * capacity - total - waste  # what a better packing may still waste
            fair = max(0, spare) // (len(best) - len(stack))
            stack.append([top, search.fillings(capacity - top, spare, fair) if spare >= 0 else iter(()), None, waste])
        frame = stack[-1] if stack else None
        if frame is None:
            break
        if frame[2] is not None:  # undo the filling that has been explored
            for x in frame[2]:
                put(x)
            frame[2] = None
        down = False
        for filling in frame[1]:
            spent = frame[3] + capacity - frame[0] - sum(filling)
            if spent <= (len(best) - 1) * capacity - total:
                for x in filling:
                    take(x)
                frame[2], waste, down = filling, spent, True
                break
        if not down:
            put(frame[0])
            stack.pop()
    return best


def _pack_group(capacity: int):
    def run(table: pa.Table) -> pa.Table:
        lengths = table.column("length").to_pylist()
        group, waiting = table.column("grp")[0].as_py(), {}
        for row, x in enumerate(lengths):
            waiting.setdefault(x, []).append(row)
        sequence, offset = [0] * len(lengths), [0] * len(lengths)
        for number, own in enumerate(bin_completion(lengths, capacity)):
            at = 0
            for x in own:
                row = waiting[x].pop()
                sequence[row], offset[row] = (group << 32) + number, at
                at += x
        out = table.drop_columns(["grp"])
        return out.append_column("sequence_id", pa.array(sequence, pa.int64())).append_column("offset", pa.array(offset, pa.int64()))
    return run


def tokenize_pieces(df: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                    capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32, ids (null unless asked for)."""
    src = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    kind = src.schema["id"].dataType.simpleString()
    return src.mapInArrow(releasing(_pieces(tokenizer_path, capacity, with_ids)),
                          f"id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, ids array<bigint>")


def pack_documents(df: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                   capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """The pieces of :func:`tokenize_pieces` with the sequence each stands in and its offset there."""
    pieces = tokenize_pieces(df, tokenizer_path, id_col, text_col, capacity, with_ids)
    pieces = materialise(pieces if with_ids else pieces.drop("ids"), "pack-pieces").withColumn(
        "row", F.monotonically_increasing_id())
    full, rest = pieces.filter(F.col("length") == capacity), pieces.filter(F.col("length") < capacity)
    groups = max(1, -(-rest.count() // GROUP_PIECES))
    rest = rest.withColumn("grp", F.pmod(F.xxhash64("row"), F.lit(groups)))
    names = [f"`{f.name}` {f.dataType.simpleString()}" for f in rest.schema if f.name not in ("grp", "row")]
    packed = rest.drop("row").groupBy("grp").applyInArrow(
        releasing_groups(_pack_group(capacity)), ", ".join([*names, "sequence_id bigint", "offset bigint"]))
    alone = full.withColumn("sequence_id", -F.col("row") - 1).withColumn("offset", F.lit(0).cast("long")).drop("row")
    return packed.unionByName(alone)
