"""Distributed operators: ingest, merge and cluster maintenance, QC metrics, sequence sets."""
