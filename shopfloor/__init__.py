"""shopfloor — plant-floor effectiveness (OEE) reporting on Spark DataFrames.

Layers:

* ``sources``   raw scans (CSV / JSON / test-table mapping), Parquet sinks, catalog.
* ``functions`` column helpers shared by every operator (rounding, exact sums, dates).
* ``operators`` DataFrame -> DataFrame building blocks: cleaning, aggregation,
  the fact table and OEE, dimensions, views, data-quality suites, warehouse load.
* ``plans``     end-to-end jobs wiring the operators together (batch ETL, warehouse load).
* ``streaming`` incremental ingestion of newly arrived raw files.
"""

__version__ = "0.1.0"
