"""delaylens: transit punctuality analytics on Spark DataFrames.

Layers (each a plain ``DataFrame -> DataFrame`` function):

- ``sources``    scans (CSV, JSON payloads, Parquet fixtures), provenance gate
- ``functions``  column expressions: key clean-up, hashing, validation rules, bands
- ``operators``  ingest, table writes, staging, marts, KPIs, quality, baseline model
- ``plans``      job graphs (model build, historical load) and the registered queries
- ``streaming``  Structured Streaming forms of the incremental jobs
"""

__all__ = ["session"]
