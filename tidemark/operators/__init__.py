"""Relational operators of incremental ingestion."""
