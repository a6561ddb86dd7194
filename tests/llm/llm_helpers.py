"""Small inputs that every operator has to take: nulls, empties, ties, repeats, clashing names."""

import re

SF_SMALL = "/root/testdata/sf0.001"

WORD = re.compile(r"[^\x20\x09-\x0d]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
#: Names that operators use inside their plans.
CLASHES = ("id", "size", "key", "rank", "text_key", "n", "root", "bucket", "set_id", "chunk", "row")


def words(text):
    return WORD.findall(text or "")


def long_text(seed, n):
    return " ".join(f"w{(seed * 7919 + i * i * 31 + i) % 9973}" for i in range(n))


def edge_rows():
    """(doc_id, text, lang, source, n_chars): the cases that the docstrings define."""
    base = long_text(1, 300)
    near = base.replace(" w", " W", 3).replace("w", "v", 1)
    rows = [
        (1, base, "en", "a"), (2, base, "en", "a"), (3, near, "en", "a"),
        (4, None, "en", "b"), (5, "", None, None), (6, " \t\n ", "de", None),
        (7, "x", "de", "b"), (8, "x y", "de", "b"), (9, long_text(2, 4000), "en", "a"),
        (10, long_text(3, 40) + "\n" + base[:400], "fr", "c"), (11, "é ü ñ " * 60, "fr", "c"),
        (12, "Straße ŒUVRE " + long_text(4, 30), None, "c"), (12, "Straße ŒUVRE " + long_text(4, 30), None, "c"),
        (None, long_text(5, 50), "en", "a"), (13, "12 34 56 -- !!", "en", "b"),
    ]
    return [(*r, None if r[1] is None else len(r[1])) for r in rows]


SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def frame(spark, rows=None, clashes=True):
    from pyspark.sql import functions as F
    df = spark.createDataFrame(edge_rows() if rows is None else rows, SCHEMA)
    for i, name in enumerate(CLASHES if clashes else ()):
        df = df.withColumn(name, F.lit(i))
    return df


def plain(rows):
    """Rows from (doc_id, text) pairs."""
    return [(i, t, "en", "a", None if t is None else len(t)) for i, t in rows]


class Groups:
    """Union-find whose root is the smallest member."""

    def __init__(self):
        self.parent = {}

    def root(self, x):
        self.parent.setdefault(x, x)
        while self.parent[x] != x:
            x = self.parent[x]
        return x

    def link(self, a, b):
        a, b = self.root(a), self.root(b)
        self.parent[max(a, b)] = min(a, b)
