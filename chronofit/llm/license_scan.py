"""License scans by canonical digest lookup (DataFrame operations only).

A text is brought to a canonical form (lower case; copyright lines dropped; every run
of characters other than letters and digits is one space; equivalent spellings unified)
and its SHA-256 is joined with the digests of the known licences, brought to the same
form by the same expressions.  The whole text is looked up, and so is each of its lines,
for the one-line notices ("Released under the MIT License.").

Scale: the known digests are a fixed list (a broadcast hash join of a few rows), so
nothing is shuffled but the documents' matched lines.

Defined cases: null and empty texts have the canonical form '' and match nothing; the
digest column then holds the digest of ''; repeated rows each keep a row; null ids are
kept (their notices are counted in the row, not by id); an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .license_texts import LICENSES, NOTICES, SPELLINGS

#: A line that starts with a copyright mark, maybe behind a comment mark, with its line break.
COPYRIGHT_LINE = "(^|\\n)[ \\t]*((#|//|/\\*|\\*|;|--)+[ \\t]*)?(copyright|©|\\(c\\))[^\\n]*"
NOT_ALNUM = "[^\\p{L}\\p{N}]+"


def without_copyright(text: Column) -> Column:
    return F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), COPYRIGHT_LINE, "\n")


def canonical(text: Column) -> Column:
    """Canonical form of a text whose copyright lines are gone."""
    spaced = F.concat(F.lit(" "), F.regexp_replace(text, NOT_ALNUM, " "), F.lit(" "))
    for variant, usual in SPELLINGS.items():
        spaced = F.replace(spaced, F.lit(f" {variant} "), F.lit(f" {usual} "))
    return F.regexp_replace(F.trim(spaced), " +", " ")


def digest(text: Column) -> Column:
    return F.sha2(canonical(text), 256)


def known_digests(spark: SparkSession, texts: dict[str, str]) -> DataFrame:
    """``(known_digest, license)`` of the fixed texts, computed by the same expressions."""
    rows = spark.createDataFrame(list(texts.items()), "known string, license string").coalesce(1)
    return rows.groupBy(digest(without_copyright(F.col("known"))).alias("known_digest")).agg(
        F.min("license").alias("license"))


def scan_licenses(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, canonical_sha256, license_id (null: none), notices, n_notices.

    ``notices``: the sorted distinct licences that its lines name, joined by a comma
    (null: none); ``n_notices``: how many lines name one.
    """
    spark = df.sparkSession
    body = without_copyright(F.col(text_col))
    notices = known_digests(spark, NOTICES).collect()  # as many rows as the fixed list
    named = F.create_map(*[F.lit(x) for r in notices for x in (r["known_digest"], r["license"])])
    found = F.filter(F.transform(F.split(body, "\n"), lambda x: F.try_element_at(named, digest(x))),
                     lambda x: x.isNotNull())
    docs = df.select(F.col(id_col).alias("id"), digest(body).alias("canonical_sha256"), found.alias("found"))
    known = F.broadcast(known_digests(spark, {text: name for name, text in LICENSES.items()}))
    return (docs.join(known, docs["canonical_sha256"] == known["known_digest"], "left")
            .select("id", "canonical_sha256", F.col("license").alias("license_id"),
                    F.nullif(F.array_join(F.array_sort(F.array_distinct("found")), ","), F.lit("")).alias("notices"),
                    F.size("found").cast("long").alias("n_notices")))


def oracle_sql() -> str:
    """The same scan in DuckDB SQL."""
    def quoted(x: str) -> str:
        return "'" + x.replace("'", "''") + "'"

    def body(x: str) -> str:
        return f"regexp_replace(lower(coalesce({x}, '')), '{COPYRIGHT_LINE}', chr(10), 'g')"

    def canon(x: str) -> str:
        out = f"(' ' || regexp_replace({x}, '{NOT_ALNUM}', ' ', 'g') || ' ')"
        for variant, usual in SPELLINGS.items():
            out = f"replace({out}, ' {variant} ', ' {usual} ')"
        return f"sha256(regexp_replace(trim({out}), ' +', ' ', 'g'))"
    licenses = ", ".join(f"({quoted(v)}, {quoted(k)})" for k, v in LICENSES.items())
    notices = ", ".join(f"({quoted(k)}, {quoted(v)})" for k, v in NOTICES.items())
    return f"""WITH known AS (SELECT {canon(body('t'))} AS d, min(l) AS license FROM (VALUES {licenses}) v(t, l) GROUP BY 1),
    named AS (SELECT {canon(body('t'))} AS d, min(l) AS license FROM (VALUES {notices}) v(t, l) GROUP BY 1),
    docs AS (SELECT row_number() OVER () AS rid, doc_id, {body('text')} AS body FROM documents),
    lines AS (SELECT rid, unnest(string_split(body, chr(10))) AS line FROM docs),
    hits AS (SELECT rid, string_agg(DISTINCT license, ',' ORDER BY license) AS notices, count(*) AS n
      FROM (SELECT rid, {canon('line')} AS d FROM lines) JOIN named USING (d) GROUP BY rid),
    sums AS (SELECT rid, doc_id, {canon('body')} AS canonical_sha256 FROM docs)
    SELECT doc_id, canonical_sha256, license AS license_id, notices, coalesce(n, 0) AS n_notices
    FROM sums LEFT JOIN known ON canonical_sha256 = known.d LEFT JOIN hits USING (rid)"""
