"""The batch operators over Structured Streaming file sources."""

from quarry.streaming.files import stream_csv, stream_json_lines, write_snapshots

__all__ = ["stream_csv", "stream_json_lines", "write_snapshots"]
