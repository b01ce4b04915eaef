from millrace.sinks.loads import LOAD, LoadedFiles, LoadedMessages, LoadedTable, Progress, in_time
from millrace.sinks.tables import (
    append_table,
    counted,
    ensure_database,
    files,
    laid_out,
    overwrite_partitions,
    overwrite_table,
    publish,
    put_back,
    replace_interval,
    setting,
    writing,
)
from millrace.sinks.versions import (
    commit_version,
    current_data_table,
    current_version,
    expire_versions,
    read_version,
    roll_back,
    snapshot_sql,
    version_history,
)

__all__ = [
    "LOAD",
    "LoadedFiles",
    "LoadedMessages",
    "LoadedTable",
    "Progress",
    "append_table",
    "counted",
    "commit_version",
    "current_data_table",
    "current_version",
    "ensure_database",
    "expire_versions",
    "files",
    "in_time",
    "laid_out",
    "overwrite_partitions",
    "overwrite_table",
    "publish",
    "put_back",
    "read_version",
    "replace_interval",
    "roll_back",
    "setting",
    "snapshot_sql",
    "version_history",
    "writing",
]
