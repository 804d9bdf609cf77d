"""courtview: audience analytics on Spark.

Entry points:

* ``courtview.plans.staged.staged(spark, sf_dir, binding)`` - the published 32-column staged table.
* ``courtview.plans.reports`` / ``courtview.plans.dashboards`` - report queries and dashboard sheets over it.
* ``courtview.operators`` - sentiment, features and flags, exact quantiles, shape, skew and broadcast helpers.
* ``courtview.sources`` - bindings of the driver tables, file and table I/O, landed JSON payloads.
* ``courtview.streaming.landing`` - incremental landing of payload folders.
* ``courtview.registry`` - every query key and its DuckDB statement (used by ``__spark_entry__``).
"""

__version__ = "0.1.0"
