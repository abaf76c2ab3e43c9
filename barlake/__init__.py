"""barlake: a Spark-native medallion layer for minute bars and company profiles.

Bronze keeps every load (append-only, partitioned by load date), silver keeps the
latest load per business key (keyed upsert), gold keeps daily returns and
volatility per ticker. Every piece is a plain DataFrame operator.

Where to start:

* ``barlake.sources.Lake``: the bronze/silver/gold tables of one lake folder.
* ``barlake.plans``: the jobs (``bronze_bars_job`` ... ``gold_metrics_job``).
* ``barlake.operators``: ``daily_metrics``, ``latest_record``, ``upsert``,
  ``row_number_by`` and the other operators.
* ``barlake.sinks``: ``append_partitioned``, ``upsert_table``.
* ``barlake.streaming.ingest_landing``: incremental landing ingestion.
* ``python -m barlake <job>``: the command line.
"""

__version__ = "0.1.0"
