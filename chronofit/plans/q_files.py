"""SQL-checked queries of files and grids: malformed CSV records, the set of result tables, expected ids."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import constants as K
from ..operators.grid import missing_ranges
from ..sources.csv_io import read_csv_records, typed_loads
from ..sources.sinks import output_dir, write_results
from ..sources.tables import read_table
from . import q_relational as R
from . import sql as S
from .catalog import register
from .context import context


@register("csv_rejects", S.with_fixture() + """
SELECT CASE CAST(split_part(load_id, '-', 1) AS BIGINT) % 10 WHEN 3 THEN 'short line' WHEN 7 THEN 'long line' ELSE 'record' END AS kind, count(*) AS rows,
  CAST(sum(CASE WHEN CAST(split_part(load_id, '-', 1) AS BIGINT) % 10 IN (3, 7) THEN 0 WHEN weight IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS missing_weights
FROM development GROUP BY 1""")
def q_csv_rejects(spark, sf):
    """The labeled table as CSV lines, of which some lack a field or have one too many; records typed, lines rejected."""
    dev = context(spark, sf).development
    cols = K.LOAD_COLUMNS + [K.TARGET]
    fields = [F.coalesce(F.col(c).cast("string"), F.lit("NA")) for c in cols]
    digit = F.substring_index("load_id", "-", 1).cast("bigint") % 10
    line = (F.when(digit == 3, F.concat_ws(",", *fields[:-1])).when(digit == 7, F.concat_ws(",", *fields, F.lit("extra")))
            .otherwise(F.concat_ws(",", *fields)))
    path = output_dir(spark, "csv_lines")
    dev.select(line.alias("value")).write.text(path)
    records, rejects = read_csv_records(spark, path, cols, header=False)
    good = typed_loads(records).agg(F.lit("record").alias("kind"), F.count(F.lit(1)).alias("rows"), F.count_if(F.col("weight").isNull()).alias("missing_weights"))
    n_fields = F.size(F.split("line", ","))
    bad = rejects.groupBy(F.when(n_fields < len(cols), "short line").otherwise("long line").alias("kind")).agg(
        F.count(F.lit(1)).alias("rows"), F.lit(0).cast("long").alias("missing_weights"))
    return good.unionByName(bad)


_RESULTS = {
    "missing_values": R.q_missing_values, "numeric_summary": R.q_numeric_summary, "category_shift": R.q_category_shift,
    "distribution_shift": R.q_distribution_shift, "monthly_target_summary": R.q_monthly_target, "error_analysis": R.q_baseline_segment_errors,
    "holdout_predictions": R.q_holdout_predictions, "baseline_comparison": R.q_baseline_leaderboard, "scenario": R.q_scenario_grid,
    "stability_folds": R.q_stability_folds}


@register("result_tables", S.with_fixture(S.SPLIT_SQL, R._ERR_SQL, S.SCENARIO_SQL) + f"""
SELECT t AS "table", CAST(n AS BIGINT) AS rows, false AS differs FROM (
  SELECT 'missing_values' AS t, {sum(len(c) for c in R._TABLE_COLS.values())} AS n UNION ALL SELECT 'numeric_summary', {2 * len(R.A.AUDIT_NUMERICS)}
  UNION ALL SELECT 'category_shift', {len(R.A.AUDIT_CATEGORIES)} UNION ALL SELECT 'distribution_shift', {len(R.A.AUDIT_NUMERICS)}
  UNION ALL SELECT 'monthly_target_summary', (SELECT count(DISTINCT strftime(date, '%Y-%m')) FROM development)
  UNION ALL SELECT 'error_analysis', (SELECT count(DISTINCT month) + count(DISTINCT distance_band) + count(DISTINCT equipment) + count(DISTINCT target_band)
    + count(DISTINCT route_status) + count(DISTINCT city_status) FROM err)
  UNION ALL SELECT 'holdout_predictions', (SELECT count(*) FROM holdout) UNION ALL SELECT 'baseline_comparison', {2 * (K.STABILITY_FOLDS + 1)}
  UNION ALL SELECT 'scenario', (SELECT count(*) FROM scenario) UNION ALL SELECT 'stability_folds', {K.STABILITY_FOLDS}) q""")
def q_result_tables(spark, sf):
    """The result tables written as CSV under one manifest of fingerprints, re-read and compared with it."""
    return write_results({name: fn(spark, sf) for name, fn in _RESULTS.items()}, output_dir(spark, "results"))


@register("expected_id_gaps", """WITH found AS (SELECT DISTINCT l_orderkey AS n FROM lineitem WHERE l_quantity <= 12 AND l_discount < 5E-2),
span AS (SELECT max(o_orderkey) AS hi FROM orders),
marked AS (SELECT n, lead(n, 1, (SELECT hi FROM span) + 1) OVER (ORDER BY n) AS nx FROM (SELECT n FROM found UNION ALL SELECT 0))
SELECT CAST(n + 1 AS BIGINT) AS first_missing, CAST(nx - 1 AS BIGINT) AS last_missing, CAST(nx - n - 1 AS BIGINT) AS missing FROM marked WHERE nx > n + 1""")
def q_expected_id_gaps(spark, sf):
    """The order numbers 1 to the largest of which no small, little discounted line is there, as ranges."""
    lines = read_table(spark, sf, "lineitem").where("l_quantity <= 12 AND l_discount < 5E-2").select("l_orderkey")
    last = read_table(spark, sf, "orders").agg(F.max("o_orderkey")).first()[0]   # one number
    return missing_ranges(lines, "l_orderkey", 1, last)
