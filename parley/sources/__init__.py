"""Readers: parquet tables, recording listings, audio files."""
