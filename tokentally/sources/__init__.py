"""Sources: text files and text columns as lines, and written results."""

from tokentally.sources.results import read_counts, result_manifest
from tokentally.sources.tables import read_table
from tokentally.sources.text import read_lines, split_lines

__all__ = [
    "read_counts",
    "read_lines",
    "read_table",
    "result_manifest",
    "split_lines",
]
