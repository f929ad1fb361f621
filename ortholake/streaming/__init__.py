"""Incremental ingest on Structured Streaming."""

from ortholake.streaming.ingest import apply_edges, cluster_batch, read_catalog, read_ledger, stream_cluster_update, stream_ingest  # noqa: F401
