"""Sinks: table writes, fan-out, JSON payloads (K1-K9)."""
