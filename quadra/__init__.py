"""quadra — incident-report lake and dashboard queries on Spark.

Subpackages: ``sources`` (landing scans, partitioned lake, adapter over the
driver tables), ``functions`` (Column expressions), ``operators`` (extracts,
reports, quality), ``plans`` (ETL jobs, registered queries, SQL oracles),
``streaming`` (incremental landing ingest).
"""

__version__ = "0.1.0"
