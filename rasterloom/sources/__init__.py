"""Readers and writers: image files, Parquet tables, example records."""
