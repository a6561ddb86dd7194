"""

Every query reads the driver's tables through the ``loads`` fixture, runs over the
whole tables, and rounds DOUBLE outputs to 6 decimals (both sides) so value hashes do
not depend on float summation order.  Model queries (spark.ml) have no SQL oracle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def bigint_counts(sql: str) -> str:
    """DuckDB's count_if returns HUGEINT; cast every call to BIGINT like Spark's."""
    out, i, token = [], 0, "count_if("
    while True:
        j = sql.find(token, i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        depth, k = 1, j + len(token)
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[k], 0)
            k += 1
        out.append(sql[i:j])
        inner = bigint_counts(sql[j + len(token):k - 1])
        out.append(f"CAST(count_if({inner}) AS BIGINT)")
        i = k


def register(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = bigint_counts(oracle)
        return fn
    return deco


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load_all()
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    _load_all()
    return dict(ORACLES)


def _load_all() -> None:
    # Importing the modules registers their queries.
    from . import q_relational  # noqa: F401
    from . import q_selection  # noqa: F401
    from . import q_files  # noqa: F401
    from . import q_dirty  # noqa: F401
    from . import q_models  # noqa: F401
