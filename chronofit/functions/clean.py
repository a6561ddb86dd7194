"""Column expressions for cleaning raw load records (JVM-side, codegen-friendly)."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import constants as K

# Title case the way Python's str.title() does it: a new word starts after any
# non-letter (O'Hare, Fort-Wayne, St.Louis, 3M), whereas initcap starts one only after
# a space.  So: mark every non-letter with MARK + space, initcap, drop the marks.  All
# built-in expressions (no lambda), so the projection stays in whole-stage codegen.
_MARK = "\u0001"
_NON_LETTER = r"([^\p{L} ])"
# Numeric text accepted by the coercion: decimal / scientific / inf; anything else is NULL.
_NUMERIC_TEXT = r"^(?i)[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|inf(inity)?)$"


def normalise_category(col: Column | str) -> Column:
    """NULL -> Unknown, collapse any whitespace run to one space, trim, title-case."""
    c = F.col(col) if isinstance(col, str) else col
    squeezed = F.trim(F.regexp_replace(F.coalesce(c.cast("string"), F.lit(K.UNKNOWN)), r"(?U)\s+", " "))
    # an empty text is replaced by a pattern: a condition would compute the whole expression twice
    return title_case(F.regexp_replace(squeezed, r"\A\z", K.UNKNOWN))


def title_case(x: Column) -> Column:
    marked = F.regexp_replace(F.lower(x), _NON_LETTER, "$1" + _MARK + " ")
    return F.replace(F.initcap(marked), F.lit(_MARK + " "), F.lit(""))


def to_double(col: Column | str, dtype: T.DataType | None = None) -> Column:
    """Numeric coercion with bad values -> NULL (never NaN)."""
    c = F.col(col) if isinstance(col, str) else col
    if dtype is not None and isinstance(dtype, T.StringType):
        text = F.trim(c)
        parsed = F.when(text.rlike(_NUMERIC_TEXT), text.try_cast("double"))
    else:
        parsed = c.cast("double")
    return F.when(~F.isnan(parsed), parsed)


def to_date(col: Column | str, dtype: T.DataType | None = None) -> Column:
    """ISO dates / timestamps -> DATE; unparsable text -> NULL."""
    c = F.col(col) if isinstance(col, str) else col
    if dtype is not None and isinstance(dtype, T.StringType):
        return F.trim(c).try_cast("date")
    return c.cast("date")


def positive(c: Column) -> Column:
    """Values <= 0 are treated as missing."""
    return F.when(c > 0, c)


def in_range(c: Column, lo: float, hi: float) -> Column:
    return F.when(c.between(lo, hi), c)


def base_clean(df: DataFrame, named: Sequence[str] = ()) -> DataFrame:
    """Typed, normalised load records plus the three problem flags (``named``: columns that are normalised already).

    Missing categorical columns become ``Unknown`` and missing numerics NULL, so a
    reduced-schema table (the scenario) goes through the same transform.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    if "date" not in types:
        raise ValueError("Required column missing: date")
    out = []
    keep = [c for c in df.columns if c not in set(K.RAW_NUMERIC + K.RAW_CATEGORICAL + ["date"])]
    out += [F.col(c) for c in keep]
    out.append(to_date("date", types["date"]).alias("date"))
    for c in K.RAW_CATEGORICAL:
        src = F.col(c) if c in types else F.lit(None).cast("string")
        out.append(src if c in named else normalise_category(src).alias(c))
    num = {c: (to_double(c, types[c]) if c in types else F.lit(None).cast("double")) for c in K.RAW_NUMERIC}
    out.append(num["weight"].isNull().cast("int").alias("weight_missing"))
    out.append(F.coalesce(num["weight"] < 0, F.lit(False)).cast("int").alias("weight_sign_corrected"))
    out.append(num["market_index"].isNull().cast("int").alias("market_index_missing"))
    for c in ["distance", "weight", "market_index", "quote_signal"]:
        out.append(positive(num[c]).alias(c))
    for c in ["pickup_lat", "delivery_lat"]:
        out.append(in_range(num[c], -90.0, 90.0).alias(c))
    for c in ["pickup_lon", "delivery_lon"]:
        out.append(in_range(num[c], -180.0, 180.0).alias(c))
    return df.select(*out)


def parse_boolean(col: Column | str) -> Column:
    """true/1/yes/y -> true, false/0/no/n -> false, anything else NULL (a violation)."""
    c = F.lower(F.trim((F.col(col) if isinstance(col, str) else col).cast("string")))
    return F.when(c.isin(*K.TRUE_WORDS), F.lit(True)).when(c.isin(*K.FALSE_WORDS), F.lit(False))
