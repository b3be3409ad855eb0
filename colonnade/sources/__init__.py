"""Scans (S1-S9) and sinks (K1-K9)."""

from colonnade.sources.tables import TABLES, load_table, load_tables
from colonnade.sources.csv import (
    drop_header_row,
    empty_frame,
    read_csv_strings,
    read_csv_typed,
    read_text_positional,
    read_wide_csv,
)
from colonnade.sources.text import parse_ngram_lines, read_ngrams

__all__ = [
    "TABLES", "load_table", "load_tables", "drop_header_row", "empty_frame", "read_csv_strings",
    "read_csv_typed", "read_text_positional", "read_wide_csv", "parse_ngram_lines", "read_ngrams",
]
