"""strata: a medallion (bronze -> silver -> gold) order-analytics library on Spark.

Every operator is a ``DataFrame -> DataFrame`` function built from Spark's own
column expressions, so Catalyst sees one declarative plan per query:

* ``strata.sources``   - readers and writers (CSV contract scan, layer tables,
  log/text corpora, the order feed shaped from the star-schema tables).
* ``strata.functions`` - reusable column expressions (blank test, exact money
  rounding, Python-compatible line splitting, fixed regex values).
* ``strata.operators`` - cleansing, de-duplication, marts, quality, text jobs.
* ``strata.plans``     - the bronze/silver/gold steps and the query registry.
* ``strata.streaming`` - incremental landing-folder ingest for bronze.
* ``strata.llm``       - operators for preparing training data (self-contained).
"""

from strata.config import ConfigError, LayerConfig, preset

__all__ = ["ConfigError", "LayerConfig", "preset"]
