"""Sources: text-log scan with arrival key, Parquet stage tables, rendered test lines."""

from .parallel import spread
from .rendered import lines_from_events
from .text import arrival_key, read_log_lines

__all__ = ["arrival_key", "lines_from_events", "read_log_lines", "spread"]
