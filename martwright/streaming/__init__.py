"""Incremental (streaming) loading of extracts with a late-data monitor."""
