"""feedkiln: Spark-first ETL for landed social-feed batches.

Every operator is a plain function ``DataFrame (+ parameters) -> DataFrame``.
Times enter as parameters (``run_ts``), never ``current_timestamp()``, so a
re-run of the same inputs gives the same rows.
"""

__version__ = "0.1.0"
