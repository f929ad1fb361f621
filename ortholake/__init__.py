"""ortholake: a Spark-native engine for catalogues of assembled, annotated and
quantified sequences.

Layout
------
- ``ortholake.catalog``      table registry (StructType per table and version) and the
                             ``Catalog`` object (name -> DataFrame)
- ``ortholake.fixture``      mapping of the driver's parquet tables onto the catalogue
- ``ortholake.sources``      file scans (FASTA, annotation TSV, quant JSON, ...)
- ``ortholake.sinks``        writers (table sets, FASTA export, QC JSON, ...)
- ``ortholake.functions``    column-expression helpers (JVM-side built-ins only)
- ``ortholake.operators``    ingest, merge, cluster maintenance, QC and sequence-set jobs
- ``ortholake.plans``        the named queries and catalogue analytics (lazy DataFrames)
- ``ortholake.streaming``    incremental ingest on Structured Streaming
"""

from ortholake.catalog import Catalog

__all__ = ["Catalog"]
