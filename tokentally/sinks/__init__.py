"""Sinks: ``(word,count)`` text output."""

from tokentally.sinks.text import format_pairs, write_counts

__all__ = ["format_pairs", "write_counts"]
