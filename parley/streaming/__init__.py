"""Incremental variants: stage results arriving as files, merged per batch."""
