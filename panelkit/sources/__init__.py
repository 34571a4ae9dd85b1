"""Readers, writers, schemas and data-quality reports."""
