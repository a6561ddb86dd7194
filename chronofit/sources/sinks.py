"""Result sinks (S3, S4, S7): parquet / CSV / JSON tables and JSON documents.

Outputs go to a folder the caller names (on a cluster: shared storage, e.g. under
``spark.checkpoint.dir``); nothing is funnelled through the driver.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ensure_checkpoint_dir


def output_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder for ``name`` under the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/outputs/{name}-{uuid.uuid4().hex[:12]}"


def write_table(df: DataFrame, path: str, fmt: str = "parquet", **options) -> DataFrame:
    """Write ``df`` (overwrite) and return the re-read table (S7 validates what was written).

    In CSV a NULL is NA, so that an empty text stays one.  Parquet is packed with zstd, to write less.
    """
    writer = df.write.mode("overwrite").options(**options)
    spark = df.sparkSession
    if fmt == "parquet":
        writer.parquet(path, compression="zstd")
        return spark.read.parquet(path)
    if fmt == "csv":
        as_is = {"header": True, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False, "escape": '"', "nullValue": "NA"}
        writer.options(**as_is).csv(path)
        return spark.read.schema(df.schema).options(**as_is).csv(path)
    if fmt == "json":
        writer.json(path)
        return spark.read.schema(df.schema).json(path)
    raise ValueError(f"unknown format {fmt!r}")


def row_hash(df: DataFrame) -> Column:
    """A 32-bit hash of a row's values; doubles count to six decimals."""
    parts = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.expr(f"try_cast(round(`{f.name}` * 1000000D) AS BIGINT)")
        parts.append(F.coalesce(c.cast("string"), F.lit("~N")))
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts)), 1, 8), 16, 10).cast("long")


def fingerprint(df: DataFrame, name: str) -> DataFrame:
    """Order-insensitive table fingerprint: rows, sum of 32-bit row hashes mod 1000003, xor of hashes."""
    return df.select(row_hash(df).alias("h")).agg(
        F.lit(name).alias("table"), F.count(F.lit(1)).alias("rows"),
        F.sum(F.col("h") % 1000003).alias("hash_sum"), F.bit_xor("h").alias("hash_xor"))


def write_results(tables: dict[str, DataFrame], folder: str, fmt: str = "csv") -> DataFrame:
    """Write every result table, re-read each, and keep a manifest of fingerprints beside them.

    Returns ``(table, rows, differs)``: whether what was read back differs from what was written.
    """
    given, back = [], []
    for name, df in tables.items():
        first = write_table(df, f"{folder}/.staged/{name}")     # computed once, for the file and its fingerprint
        again = write_table(first, f"{folder}/{name}", fmt)
        given.append(fingerprint(first, name))
        back.append(fingerprint(again, name))

    def all_of(parts):
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out
    manifest = write_table(all_of(given), f"{folder}/manifest")
    read = all_of(back).select("table", *[F.col(c).alias(f"_{c}") for c in ("rows", "hash_sum", "hash_xor")])
    same = F.col("rows").eqNullSafe(F.col("_rows")) & F.col("hash_sum").eqNullSafe(F.col("_hash_sum")) & F.col("hash_xor").eqNullSafe(F.col("_hash_xor"))
    return manifest.join(read, "table", "left").select("table", "rows", (~same).alias("differs"))


def write_document(doc: DataFrame, path: str) -> None:
    """A one-row DataFrame written as one JSON document; keys sorted at every level, NULLs kept."""
    value = F.struct(*[_sorted_keys(F.col(f"`{f.name}`"), f.dataType).alias(f.name)
                       for f in sorted(doc.schema.fields, key=lambda f: f.name)])
    text = F.to_json(value, {"ignoreNullFields": "false"})
    doc.select(text.alias("value")).coalesce(1).write.mode("overwrite").text(path)


def _sorted_keys(value: Column, kind: T.DataType) -> Column:
    """``value`` with the fields of its structs in name order, at every depth."""
    if isinstance(kind, T.StructType):
        fields = [_sorted_keys(value.getField(f.name), f.dataType).alias(f.name)
                  for f in sorted(kind.fields, key=lambda f: f.name)]
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda x: _sorted_keys(x, kind.elementType))
    return value
