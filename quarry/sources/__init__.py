"""Schemas, file sources and sinks, table adapters and synthetic data."""

from quarry.sources import schemas, synth, tables
from quarry.sources.files import (
    lines_frame,
    read_csv,
    read_json_lines,
    read_parquet,
    read_text_lines,
    write_csv,
    write_json,
    write_parquet,
    write_text,
)

__all__ = [
    "lines_frame",
    "read_csv",
    "read_json_lines",
    "read_parquet",
    "read_text_lines",
    "schemas",
    "synth",
    "tables",
    "write_csv",
    "write_json",
    "write_parquet",
    "write_text",
]
