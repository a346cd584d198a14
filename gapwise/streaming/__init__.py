"""Structured Streaming form of the sessionization."""

from gapwise.streaming.sessions import run_to_files, stream_session_table

__all__ = ["run_to_files", "stream_session_table"]
