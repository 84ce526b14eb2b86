"""Readers for the report inputs (S1-S11), stand-ins over the test tables,
and append sinks (S12-S13)."""
