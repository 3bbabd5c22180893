"""Readers and writers: raw invoice files, the fact table, result tables, exports."""
