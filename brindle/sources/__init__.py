"""Tables in and out: a catalog over a folder, and readers and writers by format."""

from brindle.sources.catalog import FORMATS, read, register, table, write
from brindle.sources.scratch import scratch
from brindle.sources.segments import Segments, with_segments

__all__ = ["FORMATS", "Segments", "read", "register", "scratch", "table", "with_segments", "write"]
