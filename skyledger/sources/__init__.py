"""Readers: raw documents, partitioned tables, dimensions."""
