"""Incremental panel maintenance with Structured Streaming.

The batch merge (``union`` strategy) is a union plus a keyed aggregation,
which Structured Streaming runs unchanged: sources that land as new files
update the panel's state store, keyed by (entity, period).
"""

from panelmerge.streaming.merge_stream import panel_stream, read_source_stream, start_panel_stream

__all__ = ["panel_stream", "read_source_stream", "start_panel_stream"]
