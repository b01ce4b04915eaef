from millrace.sources.logs import LogSource, read_log, stream_log
from millrace.sources.tables import read_table, read_zones

__all__ = ["LogSource", "read_log", "read_table", "read_zones", "stream_log"]
