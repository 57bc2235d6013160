"""Streaming: incremental, exactly-once landing of raw files."""
