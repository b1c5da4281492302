"""The same operators on files that arrive over time."""

from listwright.streaming.known import write_known
from listwright.streaming.streams import (
    append_new,
    run_available,
    stream_dedupe,
    stream_lines,
    stream_normalize,
)

__all__ = ["append_new", "run_available", "stream_dedupe", "stream_lines", "stream_normalize",
           "write_known"]
