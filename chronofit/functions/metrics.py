"""Regression metrics as aggregate expressions: one pass, any grouping."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def error_terms(actual: str = "actual", predicted: str = "predicted") -> dict[str, Column]:
    y, p = F.col(actual), F.col(predicted)
    denom = F.abs(y) + F.abs(p)
    return {
        "residual": p - y,
        "absolute_error": F.abs(p - y),
        "smape_term": F.when(denom > 0, 2.0 * F.abs(p - y) / denom).when(denom == 0, F.lit(0.0)),
    }


def regression_aggs(actual: str = "actual", predicted: str = "predicted",
                    with_rows: bool = True, with_bias: bool = True) -> list[Column]:
    """rows, mae, rmse, r2, smape (percent), mean_error.

    r2 = 1 - SSE / SST with SST = n * var_pop(actual); a constant actual gives 1.0 when
    the fit is perfect and 0.0 otherwise.  A missing (NULL or NaN) actual or prediction
    makes every metric of its group NULL: a candidate is never judged on the rest.
    """
    y, p = F.col(actual), F.col(predicted)
    t = error_terms(actual, predicted)
    n = F.count(F.lit(1))
    complete = F.count_if(y.isNull() | p.isNull() | F.isnan(y.cast("double")) | F.isnan(p.cast("double"))) == 0
    sse = F.sum(F.pow(p - y, 2))
    sst = F.var_pop(y) * n
    r2 = (F.when(sst > 0, 1 - sse / sst)
          .when(sse == 0, F.lit(1.0)).otherwise(F.lit(0.0)))
    out = []
    if with_rows:
        out.append(n.alias("rows"))
    out += [
        F.when(complete, F.avg(t["absolute_error"])).alias("mae"),
        F.when(complete, F.sqrt(F.avg(F.pow(p - y, 2)))).alias("rmse"),
        F.when(complete, r2).alias("r2"),
        F.when(complete, F.avg(t["smape_term"]) * 100.0).alias("smape"),
    ]
    if with_bias:
        out.append(F.when(complete, F.avg(p - y)).alias("mean_error"))
    return out


def round_doubles(df, digits: int = 6):
    """Round every DOUBLE column (stable value hashes across engines)."""
    from pyspark.sql import types as T
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append((F.round(F.col(f.name), digits) + F.lit(0.0)).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)
