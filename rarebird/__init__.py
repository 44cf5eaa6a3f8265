"""rarebird: find unusual rows in large tables and sort them into segments.

Everything runs as Spark DataFrame expressions and Spark ML estimators:

* ``rarebird.functions``  - column expressions (membership flag, output casts, clock stamp)
* ``rarebird.operators``  - feature preparation, clustering, anomaly flags, shares and
  monitoring rows, enrichment / dedup, sampling and splits
* ``rarebird.sources``    - SQL / file sources, table sinks, model save and load
* ``rarebird.plans``      - the train / predict / bootstrap jobs and the registered checks
* ``rarebird.streaming``  - the predict job applied to each micro-batch of a stream
"""

__version__ = "0.1.0"
