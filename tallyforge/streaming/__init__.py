"""Incremental refresh of the marts from a landing folder, with Structured Streaming."""
