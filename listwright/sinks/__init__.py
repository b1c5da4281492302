"""Sinks: Parquet tables and text files of an exact number of lines.

``force`` replaces an existing output; without it a finished output is left alone. What a failed job
left behind is replaced in any case.
"""

from listwright.sinks.tables import write_table
from listwright.sinks.text import write_blocks, write_chunks, write_kinds, write_lines

__all__ = ["write_blocks", "write_chunks", "write_kinds", "write_lines", "write_table"]
