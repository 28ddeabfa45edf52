"""Readers and writers: CSV with encoding detection, paged JSON payloads,
headerless positional sheets, and ordered panel sinks."""

from panelmerge.sources.readers import (
    detect_encodings, read_csv_any_encoding, read_source,
)
from panelmerge.sources.payload import flatten_payload, read_payloads
from panelmerge.sources.positional import clean_positional, read_positional
from panelmerge.sources.sinks import write_panel

__all__ = ["detect_encodings", "read_csv_any_encoding", "read_source",
           "flatten_payload", "read_payloads", "clean_positional", "read_positional", "write_panel"]
