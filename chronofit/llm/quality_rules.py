"""Quality rules: a learned decision list over text statistics (DataFrame operations only).

Statistics are array expressions inside each row, so no text is shuffled.  A decision
list for low quality is learned by sequential covering: a rule grows one threshold
condition at a time by FOIL gain on two thirds of the labelled rows, loses trailing
conditions as long as that does not lower its worth on the other third, is kept if it
is precise there, and the rows it covers leave.  The list is emitted as one ordered
Spark conditional expression.

The learner fits on at most ``max_labelled`` labelled rows (those with the smallest hash
of their id); all else covers all rows.

Defined cases: null and empty texts have all statistics 0 and fail the base rule; labels
that are null are left out; without labels the list is empty and the base rule decides;
repeated ids each keep a row, and each joins every label of its id; null ids have no label.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise, words

WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
MAX_LABELLED = 20_000
THRESHOLDS = 32
MAX_RULES = 8
MAX_CONDITIONS = 3
#: A rule is kept if it is at least so precise on the pruning rows, and covers so many of them.
MIN_PRECISION = 0.97
MIN_COVERED = 3
SYMBOL = "[^#*$%&|<>]+"


def text_statistics(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_distinct_words per row."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = df.select(
        F.col(id_col).alias("id"), words(text).alias("w"),
        F.length(F.regexp_replace(text, SYMBOL, "")).cast("long").alias("n_symbols"),
        F.filter(F.split(text, "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]")).alias("lines"))
    # a word as its hash; a window as the hash of its words' hashes
    hashed = base.select(
        "id", "n_symbols", F.size("w").cast("long").alias("n_words"),
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.transform("w", lambda x: F.xxhash64(x)).alias("h"))
    windows = hashed.select(
        *[c for c in hashed.columns if c != "h"], F.size(F.array_distinct("h")).cast("long").alias("n_distinct_words"),
        F.when(F.col("n_words") >= WINDOW, F.transform(
            F.sequence(F.lit(0), (F.col("n_words") - WINDOW).cast("int")),
            lambda i: F.xxhash64(*[F.get(F.col("h"), i + k) for k in range(WINDOW)])))
        .otherwise(F.array().cast("array<bigint>")).alias("g"))
    repeats = windows.withColumn("repeats", F.size(F.array_distinct("g")) < F.size("g"))
    # starts of the windows whose hash stands beside an equal one in sorted order, then the words they cover
    ordered = repeats.withColumn("o", F.when(F.col("repeats"), F.sort_array(
        F.transform("g", lambda x, i: F.struct(x.alias("x"), i.alias("i"))))))

    def twice(e: Column, k: Column) -> Column:
        return (e["x"] == F.get(F.col("o"), k - 1)["x"]) | (e["x"] == F.get(F.col("o"), k + 1)["x"])
    starts = ordered.withColumn("s", F.when(F.col("repeats"), F.sort_array(F.transform(
        F.filter("o", lambda e, k: F.coalesce(twice(e, k), F.lit(False))), lambda e: e["i"]))))
    covered = F.aggregate(
        F.transform("s", lambda p, k: F.least(F.lit(WINDOW), F.coalesce(F.get(F.col("s"), k + 1) - p, F.lit(WINDOW)))),
        F.lit(0).cast("long"), lambda a, x: a + x)
    return starts.select("id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                         F.when(F.col("repeats"), covered).otherwise(F.lit(0).cast("long")).alias("n_repeat_words"),
                         "n_distinct_words")


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def features() -> dict[str, Column]:
    """The numbers that rules compare with thresholds."""
    words_ = F.greatest(F.col("n_words"), F.lit(1))
    return {
        "n_words": F.col("n_words").cast("double"),
        "word_length": F.col("word_chars") / words_,
        "symbol_share": F.col("n_symbols") / F.greatest(F.col("word_chars"), F.lit(1)),
        "dup_lines_per_100_words": F.lit(100) * F.col("n_dup_lines") / words_,
        "repeat_share": F.col("n_repeat_words") / words_,
        "distinct_share": F.col("n_distinct_words") / words_,
    }


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def holds(self, row: dict) -> bool:
        return row[self.feature] > self.threshold if self.above else row[self.feature] <= self.threshold

    def column(self) -> Column:
        value = features()[self.feature]
        return value > self.threshold if self.above else value <= self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:.6g}"


Rule = tuple[Condition, ...]


def _covers(rule: Rule, row: dict) -> bool:
    return all(c.holds(row) for c in rule)


def _counts(rule: Rule, rows: list[dict]) -> tuple[int, int]:
    hit = [r["bad"] for r in rows if _covers(rule, r)]
    return sum(hit), len(hit) - sum(hit)


def _candidates(rows: list[dict]) -> list[Condition]:
    """Midpoints between neighbouring quantiles of each feature, both directions."""
    out = []
    for name in features():
        values = sorted({r[name] for r in rows})
        step = max(1, len(values) // THRESHOLDS)
        for a, b in zip(values[::step], values[step::step]):
            out += [Condition(name, True, (a + b) / 2), Condition(name, False, (a + b) / 2)]
    return out


def learn_rules(rows: list[dict]) -> list[Rule]:
    """Decision list for ``bad`` rows; each row holds the features, ``bad`` (0 or 1) and ``fold`` (0 to 2)."""
    grow, prune = [r for r in rows if r["fold"] < 2], [r for r in rows if r["fold"] == 2]
    conditions, rules = _candidates(grow), []
    while len(rules) < MAX_RULES and any(r["bad"] for r in grow):
        rule: Rule = ()
        covered = grow
        while len(rule) < MAX_CONDITIONS:
            p0, n0 = _counts((), covered)
            if n0 == 0:
                break
            best, gain = None, 1e-9
            for c in conditions:
                p, n = _counts((c,), covered)
                if p and (g := p * (math.log2(p / (p + n)) - math.log2(p0 / (p0 + n0)))) > gain:
                    best, gain = c, g
            if best is None:
                break
            rule += (best,)
            covered = [r for r in covered if best.holds(r)]
        if not rule:
            break

        def worth(r: Rule) -> float:
            p, n = _counts(r, prune)
            return (p - n) / (p + n) if p + n else -1.0
        # trailing conditions go while that does not lower the worth and leaves a precise rule
        while len(rule) > 1 and worth(rule[:-1]) >= worth(rule):
            rule = rule[:-1]
        p, n = _counts(rule, prune)
        if p + n < MIN_COVERED or p / (p + n) < MIN_PRECISION:
            break
        rules.append(rule)
        grow, prune = ([r for r in part if not _covers(rule, r)] for part in (grow, prune))
    return rules


def labelled_rows(stats: DataFrame, labels: DataFrame, label_id: str, label_col: str, max_labelled: int) -> list[dict]:
    """At most ``max_labelled`` labelled rows that pass the base rule, as dictionaries of features."""
    known = labels.select(F.col(label_id).alias("id"), F.col(label_col).alias("label")).filter(F.col("label").isNotNull())
    picked = (stats.filter(~base_failed()).join(known, "id")
              .select(*[c.alias(n) for n, c in features().items()], (F.col("label") == 0).cast("int").alias("bad"),
                      F.pmod(F.xxhash64("id"), F.lit(3)).cast("int").alias("fold"), F.xxhash64(F.col("id"), F.lit(1)).alias("at"))
              .orderBy("at", "bad", "n_words").limit(max_labelled).drop("at"))
    return [r.asDict() for r in picked.collect()]


def verdict(rules: list[Rule]) -> Column:
    """The decision list as one ordered conditional: the number of the first rule that fires, else null."""
    out = F.lit(None).cast("int")
    for i in reversed(range(len(rules))):
        fires = rules[i][0].column()
        for c in rules[i][1:]:
            fires = fires & c.column()
        out = F.when(fires, F.lit(i)).otherwise(out)
    return out


def judge_quality(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  label_id: str = "doc_id", label_col: str = "quality", max_labelled: int = MAX_LABELLED) -> DataFrame:
    """One row per document: the statistics, base_failed, rule (the number of the one that fired), kept."""
    stats = materialise(text_statistics(df, id_col, text_col), "quality-stats")
    rules = learn_rules(labelled_rows(stats, labels, label_id, label_col, max_labelled))
    judged = stats.withColumn("base_failed", base_failed()).withColumn("rule", verdict(rules))
    return judged.withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())
