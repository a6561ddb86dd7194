"""CSV inputs (S1, S2): read every column as text, then type with the coercion rules.

Reading with an explicit all-string schema keeps identifiers exactly as written
(leading zeros survive) and avoids schema inference (a full extra pass).  Typing is
the same Column expressions the cleaning uses: numeric text through the guarded
parse (bad text -> NULL, never NaN), dates ISO-only, and the usual missing-value
spellings read as NULL.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import constants as K
from ..functions.clean import to_date, to_double
from .sinks import output_dir, write_table

# Text read as missing, like the usual CSV readers' NA list.
NA_VALUES = ["", "NA", "N/A", "NULL", "null", "None", "nan", "NaN", "<NA>", "#N/A", "n/a", "-NaN", "-nan"]


def read_text_csv(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """The named columns as strings, found by the names in the header row; NA spellings -> NULL.

    A file without one of the columns is an error; their order in the file does not matter.
    """
    raw = spark.read.option("header", True).option("inferSchema", False).option("mode", "PERMISSIVE").csv(path)
    missing = [c for c in columns if c not in raw.columns]
    if missing:
        raise ValueError(f"CSV columns missing: {missing}")
    return raw.select(*[F.when(~F.trim(F.col(c)).isin(*NA_VALUES), F.col(c)).alias(c) for c in columns])


def read_csv_records(spark: SparkSession, path: str, columns: Sequence[str], header: bool = True) -> tuple[DataFrame, DataFrame]:
    """``(records, rejects)``: the columns as strings (NA spellings -> NULL), and the text of malformed lines.

    A line is malformed if it has more or fewer fields than the file has columns.  The file is
    parsed once, into a written table; ``columns`` are the file's, in order.
    """
    bad = "__malformed"
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns] + [T.StructField(bad, T.StringType())])
    parsed = (spark.read.schema(schema).option("header", header).option("mode", "PERMISSIVE").option("enforceSchema", not header)
           .option("columnNameOfCorruptRecord", bad).csv(path))
    raw = write_table(parsed, output_dir(spark, "csv_records"))
    good = raw.select(*[F.when(~F.trim(F.col(c)).isin(*NA_VALUES), F.col(c)).alias(c) for c in columns], bad)
    return good.where(F.col(bad).isNull()).drop(bad), good.where(F.col(bad).isNotNull()).select(F.col(bad).alias("line"))


def typed_loads(raw: DataFrame, id_col: str = K.ID, numeric: Sequence[str] = tuple(K.RAW_NUMERIC + [K.TARGET]),
                date_col: str = "date") -> DataFrame:
    """Typed load records: id kept as text, numerics parsed, date parsed (ISO only)."""
    out = []
    for c in raw.columns:
        if c == id_col:
            out.append(F.col(c))
        elif c in numeric:
            out.append(to_double(c, T.StringType()).alias(c))
        elif c == date_col:
            out.append(to_date(c, T.StringType()).alias(c))
        else:
            out.append(F.col(c))
    return raw.select(*out)
