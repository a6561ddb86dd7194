"""Alignment of two tokenizers over a corpus, its token pairs counted by external spill counting.

* Texts are encoded in units, cut before each space or line end behind a character that is no
  white space, and before ASCII marks behind a letter: there both tokenizers always start a
  new token (the vocabulary of the second is searched for pieces that would not), so the
  units' tokens in a row are the text's, and groups and links never cross a unit.  Each task
  keeps a bounded cache of units it has aligned, of which it forgets the least used.
* A task collects (pair, document, links) records and spills them as runs: sorted by pair,
  first-side major, one zstd blob per radix of the first id, with the pairs' document
  counts in a header.  Runs are stored in the shared folder.
* A radix with too many bytes for one part, such as that of a very frequent id, is cut into
  several by run.  In each part the headers meet in a k-way merge that counts every pair; the
  parts of one radix are merged on in a tree.  The order is first-side major, so each id's
  largest count is known as its pairs go by.
* The counts meet the runs of each part again, whose contributions stream back to the
  documents of each run, summed per part and sent as one blob.

No task holds more than a part's compressed runs and the counts of its radixes, whose number
the two vocabularies bound.

Defined cases: null and empty texts, and texts that the joined bytes of either tokenizer do
not give back, have no tokens: zeros and ''.  Repeated rows and null ids each keep a row and
count as documents.  An empty table gives no rows.  A long text is taken in sections, cut
between units; a unit (a stretch without such a space) is encoded whole.
"""

from __future__ import annotations

import hashlib
import heapq
import os
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise
from .textarrays import chunks, distinct_spans, kept_between_tasks, releasing, releasing_groups

#: Radixes of the first id; a run has a blob for each that occurs.
RADIX = 32
#: Records in a run.
RUN_RECORDS = 1 << 20
#: Compressed bytes of runs that a part may hold, merged partial counts at a node of the tree.
PART_BYTES, FAN_IN = 24 << 20, 16
#: Longer texts are taken in sections of about so many bytes.
SECTION_BYTES = 1 << 21
#: Units that a task remembers; longer ones are aligned each time.
CACHE_UNITS, CACHE_UNIT_BYTES, CACHE_BYTES = 250_000, 48, 64 << 20
#: Keys that a run offers the merge at once.
BLOCK = 1 << 14
#: Units that are encoded in one text.
_JOINED = 512
_SPACE_MARK = "▁"
_MARKS = "!\"#$%&()*,-./:;<=>?@[]^_`{|}~'"
#: ASCII letters, and the letters of two bytes that start with C3.
_LETTERS = {chr(c) for c in [*range(65, 91), *range(97, 123), *range(0xC0, 0x100)]} - {chr(0xD7), chr(0xF7)}
_LETTER = np.array([chr(b) in _LETTERS and b < 128 for b in range(256)])


def pair_key(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Pairs as numbers whose order is (radix, first id, second id)."""
    a = a.astype(np.int64)
    return (a & (RADIX - 1)) << 56 | a << 32 | b.astype(np.int64)


def _byte_alphabet() -> dict[str, int]:
    """Characters that stand for bytes in byte-level vocabularies: printable ones for themselves, the rest from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(rest)}


class Aligner:
    """Both tokenizers and the aligned units of one worker; unit numbers index the arrays."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        alphabet = _byte_alphabet()
        vocabulary = self.a.get_vocab(with_added_tokens=False)
        self.bytes_a = [b""] * (1 + max(vocabulary.values()))
        for entry, i in vocabulary.items():
            self.bytes_a[i] = bytes(alphabet[c] for c in entry)
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(_SPACE_MARK, " ").encode()
                        for i, p in enumerate(map(self.b.id_to_piece, range(self.b.get_piece_size())))]
        self.lone_space = [self.b.piece_to_id(_SPACE_MARK)]
        pieces = [p for i, p in enumerate(map(self.b.id_to_piece, range(self.b.get_piece_size()))) if not self.b.is_byte(i)]
        if any(_SPACE_MARK in p.lstrip(_SPACE_MARK) for p in pieces):
            raise ValueError("a piece of the second tokenizer goes on behind a space")
        self.starts = np.zeros(256, np.uint8)  # 1: starts a unit behind no white space, 2: behind a letter
        self.starts[32] = 1
        if not any("\n" in p for p in pieces):  # a line end in front then keeps the space away that is put before a text
            joined = {y for p in pieces for x, y in zip(p, p[1:]) if x in _LETTERS}
            self.starts[10] = 1
            self.starts[[ord(c) for c in _MARKS if c not in joined]] = 2
        self.size_a, self.size_b = (np.array(list(map(len, x))) for x in (self.bytes_a, self.bytes_b))
        self.part_a, self.part_b = list(map(len, self.bytes_a)), list(map(len, self.bytes_b))
        self.name_a, self.name_b = ([str(i) for i in range(len(x))] for x in (self.bytes_a, self.bytes_b))
        self.number: dict[bytes, int] = {}
        self.groups: list[bytes] = []
        self.held = 0
        self.used = np.zeros(1024, np.int64)
        self.stats = np.zeros((1024, 5), np.int64)  # tokens a, tokens b, groups, links, 1 if bytes differ
        self.ends = np.zeros(1025, np.int64)
        self.pairs = np.zeros(4096, np.int64)

    def forget(self) -> None:
        """Keep the most used units, half of those that the cache may hold at most; all numbers change."""
        used = self.used[:len(self.groups)]
        keep = np.zeros(len(used), bool)
        keep[list(self.number.values())] = True
        keep &= used > (np.partition(used, -CACHE_UNITS // 2)[-CACHE_UNITS // 2] if len(used) > CACHE_UNITS // 2 else 0)
        kept = np.flatnonzero(keep) if self.held <= CACHE_BYTES else keep[:0]
        new = dict(zip(kept.tolist(), range(len(kept))))
        self.number = {u: new[i] for u, i in self.number.items() if i in new}
        groups = self.groups
        self.groups = [groups[i] for i in kept.tolist()]
        self.held = sum(map(len, self.number)) + sum(map(len, self.groups))
        begin, size = self.ends[kept], self.ends[kept + 1] - self.ends[kept]
        ends = np.cumsum(size)
        at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(begin - ends + size, size)
        self.used, self.stats, self.pairs = used[kept] // 2, self.stats[kept], self.pairs[at]
        self.ends = np.concatenate([[0], ends])

    def _align(self, unit: bytes, a: list[int], b: list[int]) -> tuple[bytes, tuple, list[int]]:
        if b"".join(map(self.bytes_a.__getitem__, a)) != unit or b"".join(map(self.bytes_b.__getitem__, b)) != unit:
            return b"", (0, 0, 0, 0, 1), []
        name_a, name_b, part_a, part_b = self.name_a, self.name_b, self.part_a, self.part_b
        x, y, n_groups, gap = a[0], b[0], 0, 0  # gap: bytes that the second side is ahead
        own_a, own_b, out, links = name_a[x], name_b[y], "", []
        i, j, gap = 1, 1, part_b[y] - part_a[x]
        while True:
            links.append((x & (RADIX - 1)) << 56 | x << 32 | y)
            if not gap:
                n_groups += 1
                if i == len(a):
                    out += own_a + "|" + own_b
                    return out.encode(), (i, j, n_groups, len(links), 0), links
                out += own_a + "|" + own_b + ";"
                x, y = a[i], b[j]
                i, j, own_a, own_b, gap = i + 1, j + 1, name_a[x], name_b[y], part_b[y] - part_a[x]
            elif gap > 0:
                x = a[i]
                i, own_a, gap = i + 1, own_a + "," + name_a[x], gap - part_a[x]
            else:
                y = b[j]
                j, own_b, gap = j + 1, own_b + "," + name_b[y], gap + part_b[y]

    def _aligned(self, units: list[bytes]) -> tuple[list[bytes], list[tuple]]:
        """The units in another order, and each aligned.

        Units that may follow each other are encoded in one text, whose tokens must end where they do.
        """
        order, aligned, single = [], [], []
        joined = [u for u in units if u[0] == 32 and (32 < u[-1] < 127 or u[-1] >= 128 and 0xC3 <= u[-2] <= 0xDF)]
        for lo in range(0, len(joined), _JOINED):
            own = joined[lo:lo + _JOINED]
            text = b"".join(own).decode("utf-8")
            sides, ends = [], np.cumsum(list(map(len, own)))
            for ids, sizes in ((self.a.encode(text, add_special_tokens=False).ids, self.size_a), (self.b.encode(text[1:]), self.size_b)):
                at = np.cumsum(sizes[ids])
                cut = np.searchsorted(at, ends)
                if cut[-1] != len(ids) - 1 or (at[cut] != ends).any():
                    break
                cut = (cut + 1).tolist()
                sides.append([ids[x:y] for x, y in zip([0, *cut], cut)])
            if len(sides) == 2:
                order += own
                aligned += map(self._align, own, *sides)
        single = list(set(units).difference(order)) if len(order) < len(units) else []
        texts = [u.decode("utf-8") for u in single]
        ids_a = [e.ids for e in self.a.encode_batch(texts, add_special_tokens=False)]
        ids_b = self.b.encode([t[1:] if t[0] == " " else "\n" + t for t in texts], num_threads=1)
        ids_b = [(b or self.lone_space) if t[0] == " " else b[2:] for t, b in zip(texts, ids_b)]
        return order + single, aligned + list(map(self._align, single, ids_a, ids_b))

    def numbers(self, raw: bytes, cuts: np.ndarray) -> np.ndarray:
        """Numbers of the units between the cuts; units not met before are encoded and aligned."""
        one, kind = distinct_spans(np.frombuffer(raw, np.uint8), cuts[:-1], cuts[1:])
        units = [raw[x:y] for x, y in zip(cuts[one].tolist(), cuts[one + 1].tolist())]
        if len(self.groups) > CACHE_UNITS or self.held > CACHE_BYTES:
            self.forget()
        fresh = [u for u in units if u not in self.number]
        if fresh:
            fresh, aligned = self._aligned(fresh)
            n = len(self.groups)
            self.number.update(zip(fresh, range(n, n + len(fresh))))
            self.groups.extend(x[0] for x in aligned)
            self.held += sum(len(u) + len(x[0]) for u, x in zip(fresh, aligned))
            self.stats = _grown(self.stats, n, np.array([x[1] for x in aligned], np.int64))
            counts = np.cumsum([len(x[2]) for x in aligned])
            self.ends = _grown(self.ends, n + 1, self.ends[n] + counts)
            self.pairs = _grown(self.pairs, int(self.ends[n]), np.fromiter(chain.from_iterable(x[2] for x in aligned), np.int64, int(counts[-1])))
        out = np.fromiter(map(self.number.__getitem__, units), np.int64, len(units))[kind]
        self.used = _grown(self.used, len(self.used), np.zeros(max(0, len(self.groups) - len(self.used)), np.int64))
        self.used[:len(self.groups)] += np.bincount(out, minlength=len(self.groups))
        for u in fresh:
            if len(u) > CACHE_UNIT_BYTES:  # its number stays valid, a later one is aligned anew
                del self.number[u]
        return out

    def records(self, doc: np.ndarray, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct (document, pair) of unit occurrences, in that order, and the links of each."""
        both, times = np.unique(doc * len(self.groups) + unit, return_counts=True)
        doc, unit = np.divmod(both, len(self.groups))
        begin = self.ends[unit]
        size = self.ends[unit + 1] - begin
        total = np.cumsum(size)
        at = np.arange(total[-1] if len(total) else 0) + np.repeat(begin - total + size, size)
        return _summed(np.repeat(doc, size), self.pairs[at], np.repeat(times, size))


def _grown(have: np.ndarray, n: int, more: np.ndarray) -> np.ndarray:
    """``have`` with ``more`` written from row ``n`` on, doubled where too small."""
    if n + len(more) > len(have):
        wider = np.zeros((max(2 * len(have), n + len(more)), *have.shape[1:]), have.dtype)
        wider[:n] = have[:n]
        have = wider
    have[n:n + len(more)] = more
    return have


def _summed(doc: np.ndarray, pair: np.ndarray, links: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sums of ``links`` per (doc, pair), in that order."""
    order = np.lexsort((pair, doc))
    doc, pair = doc[order], pair[order]
    first = np.ones(len(doc), bool)
    first[1:] = (doc[1:] != doc[:-1]) | (pair[1:] != pair[:-1])
    begin = np.flatnonzero(first)
    return doc[begin], pair[begin], np.add.reduceat(links[order], begin) if len(begin) else links[:0]


def cut_points(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Where units start: see ``Aligner.starts``; behind ASCII and some two-byte characters only."""
    at = np.flatnonzero(starts[data])
    at = at[at > 1]
    last, lead = data[at - 1], data[at - 2]
    two = (last >= 128) & (lead >= 0xC3) & (lead <= 0xDF)
    letter = _LETTER[last] | two & (lead == 0xC3) & (last != 0x97) & (last != 0xB7)
    return at[np.where(starts[data[at]] == 1, ((last > 32) & (last < 127)) | two, letter)]


def sections(text: bytes, size: int, starts: np.ndarray) -> Iterator[bytes]:
    """A text (with its space in front) in pieces of about ``size`` bytes that start where units do."""
    begin = 0
    while len(text) - begin > size:
        reach = size
        while True:
            cuts = cut_points(np.frombuffer(text, np.uint8, min(reach, len(text) - begin), begin), starts)
            if len(cuts) or begin + reach >= len(text):
                break
            reach *= 2
        if not len(cuts):
            break
        yield text[begin:begin + int(cuts[-1])]
        begin += int(cuts[-1])
    yield text[begin:]


def squeeze(*arrays: np.ndarray) -> bytes:
    """Arrays of 32-bit numbers as one zstd blob of byte planes."""
    planes = b"".join(x.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes() for x in arrays)
    return zstandard.ZstdCompressor(level=1).compress(planes)


def unsqueeze(blob: bytes, *sizes: int) -> list[np.ndarray]:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob, max_output_size=max(1, 4 * sum(sizes))), np.uint8)
    out, at = [], 0
    for n in sizes:
        out.append(np.ascontiguousarray(raw[at:at + 4 * n].reshape(4, n).T).view("<u4").ravel().astype(np.int64))
        at += 4 * n
    return out


def pack_counts(keys: np.ndarray, counts: np.ndarray) -> bytes:
    step = np.diff(keys, prepend=0)
    return squeeze(step >> 32, step & 0xFFFFFFFF, counts & 0xFFFFFFFF, counts >> 32)


def unpack_counts(blob: bytes, n: int) -> tuple[np.ndarray, np.ndarray]:
    high, low, count, more = unsqueeze(blob, n, n, n, n)
    return np.cumsum(high << 32 | low), more << 32 | count


def merge_counts(runs: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """K-way merge of sorted (key, count) runs: each key once, its counts summed.

    A heap holds the runs by their next key.  Every round takes what all runs hold up to the
    least last key of their next blocks, so no run is read ahead of the others.
    """
    at = [0] * len(runs)
    heap = [(int(keys[0]), i) for i, (keys, _) in enumerate(runs) if len(keys)]
    heapq.heapify(heap)
    out: list[tuple[np.ndarray, np.ndarray]] = []
    while heap:
        limit = min(int(runs[i][0][min(at[i] + BLOCK, len(runs[i][0])) - 1]) for _, i in heap)
        part = []
        while heap and heap[0][0] <= limit:
            _, i = heapq.heappop(heap)
            keys, counts = runs[i]
            end = int(np.searchsorted(keys, limit, "right"))
            part.append((keys[at[i]:end], counts[at[i]:end]))
            at[i] = end
        for i in {i for i, (keys, _) in enumerate(runs) if at[i] < len(keys)} - {i for _, i in heap}:
            heapq.heappush(heap, (int(runs[i][0][at[i]]), i))
        keys, counts = (np.concatenate(x) for x in zip(*part))
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
        begin = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        out.append((keys[begin], np.add.reduceat(counts, begin)))
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    keys, counts = (np.concatenate(x) for x in zip(*out))
    return keys, counts


def best_of_first(keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Whether a pair's count is the largest of its first id (the keys are first-side major)."""
    first = keys >> 32
    begin = np.flatnonzero(np.concatenate([[True], first[1:] != first[:-1]])) if len(keys) else np.zeros(0, np.int64)
    most = np.maximum.reduceat(counts, begin) if len(begin) else counts
    return counts == np.repeat(most, np.diff(np.append(begin, len(keys))))


_workers: dict[tuple[str, str], Aligner] = kept_between_tasks(__name__)


def _aligner(path_a: str, path_b: str) -> Aligner:
    if (path_a, path_b) not in _workers:
        _workers[path_a, path_b] = Aligner(path_a, path_b)
    return _workers[path_a, path_b]


def _units_of(texts: list[bytes], unit_starts: np.ndarray) -> tuple[bytes, np.ndarray, np.ndarray]:
    """Several texts (each with its space in front) in a row, where their units are cut, and the text of each unit."""
    raw = b"".join(texts)
    edges = np.cumsum([0, *map(len, texts)])
    cuts = np.union1d(cut_points(np.frombuffer(raw, np.uint8), unit_starts), edges)
    return raw, cuts, np.searchsorted(edges, cuts[:-1], "right") - 1


def align_texts(aligner: Aligner, texts: list[bytes]) -> tuple[np.ndarray, list[str], tuple]:
    """Statistics, group digests and records of non-empty texts without their space in front."""
    short = [i for i, t in enumerate(texts) if len(t) <= SECTION_BYTES]
    stats, digests = np.zeros((len(texts), 5), np.int64), [""] * len(texts)
    found = []
    if short:
        raw, cuts, owner = _units_of([b" " + texts[i] for i in short], aligner.starts)
        number = aligner.numbers(raw, cuts)
        sums = np.add.reduceat(aligner.stats[number], np.searchsorted(owner, np.arange(len(short))), axis=0)
        stats[short] = sums
        ends = np.searchsorted(owner, np.arange(len(short)), "right").tolist()
        names = list(map(aligner.groups.__getitem__, number.tolist()))
        for i, x, y in zip(short, [0, *ends], ends):
            digests[i] = hashlib.sha256(b";".join(names[x:y])).hexdigest()
        good = (sums[:, 4] == 0)[owner]
        found.append(aligner.records(np.array(short)[owner[good]], number[good]))
    for i in (i for i, t in enumerate(texts) if len(t) > SECTION_BYTES):
        digest, held, first = hashlib.sha256(), (np.zeros(0, np.int64),) * 3, True
        for section in sections(b" " + texts[i], SECTION_BYTES, aligner.starts):
            raw, cuts, _ = _units_of([section], aligner.starts)
            number = aligner.numbers(raw, cuts)
            stats[i] += aligner.stats[number].sum(axis=0)
            digest.update((b"" if first else b";") + b";".join(map(aligner.groups.__getitem__, number.tolist())))
            more = aligner.records(np.full(len(number), i), number)
            held, first = _summed(*(np.concatenate(x) for x in zip(held, more))), False
        digests[i] = digest.hexdigest()
        if not stats[i, 4]:
            found.append(held)
    for i in np.flatnonzero(stats[:, 4]).tolist():
        stats[i], digests[i] = 0, ""
    records = tuple(np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.int64),) * 3
    return stats, digests, records


def _spill(path_a: str, path_b: str, id_type: pa.DataType, schema: pa.Schema):
    """Rows (id, text) to one row per document and the blobs of the task's runs."""
    def rows(kind: int, n: int, columns: dict) -> pa.RecordBatch:
        columns = {"kind": pa.array(np.full(n, kind, np.int32))} | columns
        return pa.RecordBatch.from_arrays([columns[f.name].cast(f.type) if f.name in columns else pa.nulls(n, f.type) for f in schema], schema=schema)

    def flush(run: int, ids: list, stats: list, digests: list, parts: list) -> Iterator[pa.RecordBatch]:
        table, n = np.concatenate(stats), len(digests)
        yield rows(0, n, {"id": pa.chunked_array(ids, id_type).combine_chunks(), "run": pa.array(np.full(n, run, np.int64)), "doc": pa.array(np.arange(n, dtype=np.int32)),
                          **{c: pa.array(table[:, k]) for k, c in enumerate(("n_a", "n_b", "n_groups", "n_links"))}, "groups_sha256": pa.array(digests, pa.string())})
        doc, pair, links = (np.concatenate(x) for x in zip(*parts))
        order = np.argsort(pair, kind="stable")  # documents stay in order
        doc, pair, links = doc[order], pair[order], links[order]
        begin = np.flatnonzero(np.concatenate([[True], pair[1:] != pair[:-1]])) if len(pair) else np.zeros(0, np.int64)
        keys, counts = pair[begin], np.diff(np.append(begin, len(pair)))
        radix = keys >> 56
        used, first = np.unique(radix, return_index=True)
        buckets, heads, bodies, n_keys, n_records = [], [], [], [], []
        for r, x, y in zip(used.tolist(), first.tolist(), [*first[1:].tolist(), len(keys)]):
            lo, hi = int(begin[x]), int(begin[y]) if y < len(keys) else len(pair)
            buckets.append(r)
            heads.append(pack_counts(keys[x:y], counts[x:y]))
            bodies.append(squeeze(np.diff(doc[lo:hi], prepend=0) & 0xFFFFFFFF, links[lo:hi]))
            n_keys.append(y - x)
            n_records.append(hi - lo)
        if buckets:
            yield rows(1, len(buckets), {"run": pa.array(np.full(len(buckets), run, np.int64)), "radix": pa.array(buckets), "head": pa.array(heads, pa.binary()),
                                         "body": pa.array(bodies, pa.binary()), "n_keys": pa.array(n_keys), "n_records": pa.array(n_records)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, number = _aligner(path_a, path_b), TaskContext.get().partitionId() << 24
        held: list[list] = [[], [], [], []]
        n_docs = n_records = 0
        for batch in batches:
            for first, stop, data, offsets in chunks(batch.column("text")):
                raw, at = data.tobytes(), offsets.tolist()
                texts = [raw[x:y] for x, y in zip(at, at[1:])]
                given = [i for i, t in enumerate(texts) if t]
                stats, digests, (doc, pair, links) = align_texts(aligner, [texts[i] for i in given])
                table, names = np.zeros((len(texts), 5), np.int64), [""] * len(texts)
                table[given] = stats
                for i, d in zip(given, digests):
                    names[i] = d
                held[0].append(batch.column("id").slice(first, stop - first))
                held[1].append(table)
                held[2].extend(names)
                held[3].append((np.array(given, np.int64)[doc] + n_docs, pair, links))
                n_docs, n_records = n_docs + len(texts), n_records + len(pair)
                if n_records >= RUN_RECORDS:
                    yield from flush(number, *held)
                    held, n_docs, n_records, number = [[], [], [], []], 0, 0, number + 1
        if n_docs:
            yield from flush(number, *held)
    return run


def _merge(table: pa.Table) -> pa.Table:
    """Runs' headers or partial counts of one node to one row of counts."""
    runs = [unpack_counts(blob, n) for blob, n in zip(table.column("head").to_pylist(), table.column("n_keys").to_pylist())]
    keys, counts = merge_counts(runs)
    return pa.table({"radix": table.column("radix").slice(0, 1), "node": table.column("node").slice(0, 1),
                     "n_keys": pa.array([len(keys)], pa.int64()), "head": pa.array([pack_counts(keys, counts)], pa.binary())})


def _contribute(runs: pa.Table, counts: pa.Table) -> pa.Table:
    """One part: what its records add to their documents, a blob for each run."""
    out: dict[int, list] = {}
    if len(runs):
        keys, count = unpack_counts(counts.column("head")[0].as_py(), counts.column("n_keys")[0].as_py())
        best = best_of_first(keys, count)
        for run, head, body, n, size in zip(*(runs.column(c).to_pylist() for c in ("run", "head", "body", "n_keys", "n_records"))):
            own, times = unpack_counts(head, n)
            step, links = unsqueeze(body, size, size)
            doc = np.cumsum(step.astype(np.uint32), dtype=np.uint32).astype(np.int64)
            at = np.repeat(np.searchsorted(keys, own), times)
            out.setdefault(run, []).append((doc, np.where(best[at], links, 0), links * count[at]))
    names, blobs, sizes = [], [], []
    for run, parts in out.items():
        doc, best, total = _totals(*(np.concatenate(x) for x in zip(*parts)))
        names.append(run)
        sizes.append(len(doc))
        blobs.append(squeeze(np.diff(doc, prepend=0), best, total & 0xFFFFFFFF, total >> 32))
    return pa.table([pa.array(names, pa.int64()), pa.array(sizes, pa.int64()), pa.array(blobs, pa.binary())], names=["run", "n", "added"])


def _totals(doc: np.ndarray, best: np.ndarray, total: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sums of the two figures per document."""
    order = np.argsort(doc, kind="stable")
    doc = doc[order]
    begin = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]])) if len(doc) else np.zeros(0, np.int64)
    return doc[begin], *(np.add.reduceat(x[order], begin) if len(begin) else x for x in (best, total))


def _gather(table: pa.Table) -> pa.Table:
    """What all parts add to the documents of one run."""
    parts = []
    for n, blob in zip(table.column("n").to_pylist(), table.column("added").to_pylist()):
        step, best, low, high = unsqueeze(blob, n, n, n, n)
        parts.append((np.cumsum(step), best, high << 32 | low))
    doc, best, total = _totals(*(np.concatenate(x) for x in zip(*parts)))
    return pa.table({"run": np.full(len(doc), table.column("run")[0].as_py()), "doc": doc.astype(np.int32), "n_best": best, "count_sum": total})


def _parts(runs: DataFrame) -> list[tuple[int, int]]:
    """``(radix, parts)``: how many parts the bytes of each radix need."""
    sizes = runs.groupBy("radix").agg(F.sum(F.length("head") + F.length("body")).alias("n")).collect()  # RADIX rows at most
    return sorted((r["radix"], -(-r["n"] // PART_BYTES)) for r in sizes)


def align_tokenizers(df: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    spark = df.sparkSession
    src = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    id_type = src.schema["id"].dataType
    from pyspark.sql.pandas.types import to_arrow_type
    kinds = [("kind", pa.int32()), ("id", to_arrow_type(id_type)), ("run", pa.int64()), ("doc", pa.int32()), ("n_a", pa.int64()), ("n_b", pa.int64()),
             ("n_groups", pa.int64()), ("n_links", pa.int64()), ("groups_sha256", pa.string()), ("radix", pa.int32()), ("head", pa.binary()),
             ("body", pa.binary()), ("n_keys", pa.int64()), ("n_records", pa.int64())]
    ddl = (f"kind int, id {id_type.simpleString()}, run bigint, doc int, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, "
           "groups_sha256 string, radix int, head binary, body binary, n_keys bigint, n_records bigint")
    spilled = materialise(src.mapInArrow(releasing(_spill(path_a, path_b, kinds[1][1], pa.schema(kinds))), ddl), "align-runs")
    docs = spilled.filter("kind = 0").select("id", "run", "doc", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")
    runs = spilled.filter("kind = 1").select("run", "radix", "head", "body", "n_keys", "n_records")

    dealt = _parts(runs)
    deal = F.broadcast(spark.createDataFrame(dealt, "radix int, parts int"))  # RADIX rows at most
    most = max((n for _, n in dealt), default=1)
    runs = runs.join(deal, "radix").withColumn("node", F.pmod(F.xxhash64("run"), F.col("parts")).cast("int"))
    shape = "radix int, node int, n_keys bigint, head binary"
    counts = runs.select("radix", "node", "n_keys", "head").groupBy("radix", "node").applyInArrow(releasing_groups(_merge), shape)
    while most > 1:
        counts = counts.withColumn("node", F.floor(F.col("node") / FAN_IN).cast("int")).groupBy("radix", "node").applyInArrow(releasing_groups(_merge), shape)
        most = -(-most // FAN_IN)
    counts = materialise(counts, "align-counts")
    spread = counts.join(deal, "radix").select("radix", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("node"), "n_keys", "head")
    added = runs.groupBy("radix", "node").cogroup(spread.groupBy("radix", "node")).applyInArrow(
        releasing_groups(_contribute), "run bigint, n bigint, added binary")
    added = added.groupBy("run").applyInArrow(releasing_groups(_gather), "run bigint, doc int, n_best bigint, count_sum bigint")
    return docs.join(added, ["run", "doc"], "left").select(
        "id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", F.lit(0)).cast("long").alias("n_best"),
        F.coalesce("count_sum", F.lit(0)).cast("long").alias("count_sum"), "groups_sha256")
