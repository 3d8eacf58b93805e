"""fundlake: a Spark-native pipeline that turns landed web articles into a
reconciled company / funding-round dataset.

Subpackages:
    sources    - stage readers (CSV/Parquet stages, landed pages, records)
    sinks      - stage writers
    functions  - Column -> Column building blocks (JSON/VARIANT, dates, names)
    operators  - DataFrame -> DataFrame operators (extract, enrich, reconcile)
    plans      - end-to-end compositions and the registered query set
    streaming  - incremental landing of pages with Structured Streaming
"""

__version__ = "0.1.0"
