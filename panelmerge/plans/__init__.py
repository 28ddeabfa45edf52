"""Composite reports, chart tables, the spec-driven pipeline, and the
bindings of all of them to the driver's test tables."""
