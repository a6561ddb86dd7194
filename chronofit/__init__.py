"""chronofit: chronological tabular-regression workflows expressed as Spark jobs.

Sub-packages
------------
sources    table readers, the ``loads`` fixture, CSV/JSON/parquet sinks
functions  Column-expression builders (cleaning, dates, geography, metrics)
operators  DataFrame -> DataFrame operators (features, splits, audits, models)
plans      the query catalog registered in ``__spark_entry__`` and the full run
streaming  the fitted transform applied to ``readStream`` input
"""

__version__ = "0.1.0"
