"""tabml — tabular analytics and machine learning on Spark DataFrames.

Layers:

* ``tabml.sources``    — table readers (parquet, CSV with inferred or fixed schema) and the metrics sink.
* ``tabml.functions``  — column expressions: safe casts, duration parsing, bands, ratios, hash buckets.
* ``tabml.operators``  — relational helpers, profiling, splitting, feature stages, estimators,
                         model tables and one-pass evaluators.
* ``tabml.plans``      — job specifications (in code or as JSON), the job runner and the query catalogue.

``python -m tabml`` lists, runs jobs (by name or JSON file) and runs or explains single queries.

Everything is expressed with the DataFrame API and Spark ML; nothing pulls table data to the driver.
"""

__version__ = "0.1.0"
