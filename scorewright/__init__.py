"""scorewright: behavioural credit scoring as Spark DataFrame jobs.

Sub-packages:

* ``sources``   – table readers, the statement/event fixtures, prediction CSV and the
                  Parquet feature store.
* ``functions`` – column-level helpers (epoch micros, date features, md5 scores).
* ``operators`` – DataFrame -> DataFrame steps: ordered scans, lags, aggregation,
                  target encoding, ranks, metrics, folds, stacking, ensembles.
* ``plans``     – end-to-end feature/training plans and the registered queries.
"""

__version__ = "0.1.0"
