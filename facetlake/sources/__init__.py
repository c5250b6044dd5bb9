"""Readers and writers of the binary tile container, its configuration, and Parquet tables."""
