"""Language ID by hyperdimensional profiles.

Each letter has a random vector of +1 and -1; an n-gram is bound as the product of its
letters' vectors, permuted (rolled) by their place; a text is the bundle (sum) of its
n-gram vectors.  A language's prototype bundles its training texts, and a text gets the
language whose prototype has the largest cosine with it.

Texts are lower-cased; every run of other characters than letters is one word border.
Training sums one vector per language and task, so a task returns a few rows; the
prototypes (languages x dimensions) are the only thing that reaches the driver.

Defined cases: a null text, or one without letters, is ``und`` with score 0, and so is
every text if there is no training row; null languages are not learned; ties go to the
first language in code-point order; a null id is neither held out nor trained on.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bound_batches
from .textarrays import CHUNK_BYTES, CHUNK_ROWS, releasing

DIMENSIONS = 1024
GRAM = 3
SEED = 41
UNKNOWN = "und"
#: Different n-grams that are turned into vectors at once.
BLOCK = 2048
_letters: dict[int, np.ndarray] = {}
_alpha = np.full(0x110000, -1, np.int8)  # 1: letter, 0: not, -1: not looked up yet


def letter_vector(code: int) -> np.ndarray:
    """The random vector of a code point (0: word border); the same on every executor."""
    if code not in _letters:
        bits = np.random.default_rng([SEED, code]).integers(0, 2, DIMENSIONS)
        _letters[code] = (bits * 2 - 1).astype(np.float32)
    return _letters[code]


def _codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Letters as code points with 0 for a word border, and the row of each; a border at both ends."""
    lowered = [f" {t.lower()} " for t in texts]
    codes = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), np.uint32)
    rows = np.repeat(np.arange(len(texts)), [len(t) for t in lowered])
    if (_alpha[codes] < 0).any():
        for c in np.unique(codes[_alpha[codes] < 0]).tolist():
            _alpha[c] = chr(c).isalpha()
    codes = np.where(_alpha[codes] > 0, codes, 0)
    if len(codes):
        repeat = np.zeros(len(codes), bool)
        repeat[1:] = (codes[1:] == 0) & (codes[:-1] == 0) & (rows[1:] == rows[:-1])
        codes, rows = codes[~repeat], rows[~repeat]
    return codes, rows


def gram_blocks(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Counts of n-grams (texts x grams) and the vector of each gram (grams x dimensions).

    At most ``BLOCK`` different n-grams at a time, so memory does not grow with the alphabet.
    """
    codes, rows = _codes(texts)
    alphabet, ids = np.unique(codes, return_inverse=True)
    size, n = len(alphabet), len(codes) - GRAM + 1
    if n <= 0 or not alphabet.any():
        return
    grams, some = np.zeros(n, np.int64), np.zeros(n, bool)
    for k in range(GRAM):
        grams = grams * size + ids[k:n + k]
        some |= codes[k:n + k] > 0
    inside = (rows[:n] == rows[GRAM - 1:]) & some
    kinds, at = np.unique(grams[inside], return_inverse=True)
    row = rows[:n][inside]
    for first in range(0, len(kinds), BLOCK):
        block = kinds[first:first + BLOCK]
        own = slice(None) if len(kinds) <= BLOCK else (at >= first) & (at < first + len(block))
        counts = np.bincount(row[own] * len(block) + (at[own] - first), minlength=len(texts) * len(block))
        letters, places = np.unique(np.stack([block // size ** (GRAM - 1 - k) % size for k in range(GRAM)]), return_inverse=True)
        table = np.stack([letter_vector(int(alphabet[c])) for c in letters])
        vectors = np.ones((len(block), DIMENSIONS), np.float32)
        for k, place in enumerate(places.reshape(GRAM, -1)):  # the letter at place k is rolled by the places after it
            vectors *= np.roll(table, GRAM - 1 - k, axis=1)[place]
        yield counts.reshape(len(texts), len(block)).astype(np.float32), vectors


def _text_chunks(column: pa.Array) -> Iterator[tuple[int, list[str]]]:
    """Texts of a column in runs of bounded size, and the row each run starts at."""
    for lo in range(0, len(column), CHUNK_ROWS):
        for first, texts in _runs(column.slice(lo, CHUNK_ROWS).to_pylist()):
            yield lo + first, texts


def _runs(texts: list[str]) -> Iterator[tuple[int, list[str]]]:
    first, size = 0, 0
    for i, t in enumerate(texts):
        if size and size + len(t) > CHUNK_BYTES // 2:
            yield first, texts[first:i]
            first, size = i, 0
        size += len(t)
    if first < len(texts):
        yield first, texts[first:]


def _bundle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One bundle per language of this task: columns lang, text in; lang, vector out."""
    sums: dict[str, np.ndarray] = {}
    for batch in batches:
        langs = batch.column(0).to_pylist()
        for first, texts in _text_chunks(batch.column(1)):
            own = np.array(langs[first:first + len(texts)], dtype=object)
            for counts, vectors in gram_blocks(texts):
                for lang in set(own):
                    sums.setdefault(lang, np.zeros(DIMENSIONS))
                    sums[lang] += counts[own == lang].sum(axis=0, dtype=np.float64) @ vectors
    yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.string()),
                                      pa.array([v.tolist() for v in sums.values()], pa.list_(pa.float64()))], ["lang", "vector"])


def learn_prototypes(train: DataFrame, lang_col: str = "lang", text_col: str = "text") -> dict[str, np.ndarray]:
    """Unit prototype per language.  The sums are whole numbers, so their order does not matter."""
    bound_batches(train.sparkSession)
    rows = train.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).filter(
        F.col("lang").isNotNull() & F.col("text").isNotNull())
    parts = rows.mapInArrow(releasing(_bundle), "lang string, vector array<double>")
    sums = (parts.select("lang", F.posexplode("vector").alias("i", "v")).groupBy("lang", "i").agg(F.sum("v").alias("v"))
            .groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("i", "v"))).alias("x")).select("lang", "x.v"))
    out = {r["lang"]: np.array(r["v"], np.float64) for r in sums.collect()}
    return {k: (v / np.linalg.norm(v)).astype(np.float32) for k, v in sorted(out.items()) if np.linalg.norm(v) > 0}


def identify(df: DataFrame, prototypes: dict[str, np.ndarray], text_col: str = "text") -> DataFrame:
    """``df`` without its text column, with ``lang_pred`` and ``score``; these names must be free."""
    bound_batches(df.sparkSession)
    names = list(prototypes)
    table = np.stack([prototypes[k] for k in names]) if names else np.zeros((0, DIMENSIONS), np.float32)
    kept = [c for c in df.columns if c != text_col]
    src = df.select(*kept, F.coalesce(F.col(text_col), F.lit("")).alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, scores = [], []
            for _, texts in _text_chunks(batch.column("__text")):
                bundles, grams = np.zeros((len(texts), DIMENSIONS), np.float32), np.zeros(len(texts))
                for counts, vectors in gram_blocks(texts):
                    bundles += counts @ vectors
                    grams += counts.sum(axis=1)
                norms = np.linalg.norm(bundles, axis=1)
                cosines = bundles @ table.T / np.maximum(norms, 1e-9)[:, None]
                some = (grams > 0) & (len(names) > 0)
                best = cosines.argmax(axis=1) if names else np.zeros(len(texts), int)
                langs += [names[b] if s else UNKNOWN for b, s in zip(best, some)]
                scores += [float(min(1.0, max(0.0, cosines[i, b]))) if s else 0.0 for i, (b, s) in enumerate(zip(best, some))]
            columns = [batch.column(c) for c in kept] + [pa.array(langs, pa.string()), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, [*kept, "lang_pred", "score"])
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema if f.name != "__text")
    return src.mapInArrow(releasing(run), f"{schema}, lang_pred string, score double")


def held_out(id_column: Column) -> Column:
    """crc32 of the id as text leaves remainder 0 by 5."""
    return F.coalesce(F.crc32(id_column.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def predict_languages(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                      carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per document: id, held_out, lang_pred, score, and the ``carry`` columns as ``carry_<name>``."""
    src = df.select(F.col(id_col).alias("id"), held_out(F.col(id_col)).alias("held_out"),
                    F.col(text_col).alias("text"), F.col(lang_col).alias("lang"), *[F.col(c).alias(f"carry_{c}") for c in carry])
    prototypes = learn_prototypes(src.filter(~F.col("held_out") & F.col("id").isNotNull()))
    return identify(src.drop("lang"), prototypes)
