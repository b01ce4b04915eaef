from millrace.streaming.ingest import run_append, run_ingest
from millrace.streaming.mirror import (
    fold_batch,
    fold_touched,
    publish_mirror,
    publish_state,
    run_mirror,
    run_stored_mirror,
)
from millrace.streaming.windows import ClosedHours

__all__ = [
    "ClosedHours",
    "fold_batch",
    "fold_touched",
    "publish_mirror",
    "publish_state",
    "run_append",
    "run_ingest",
    "run_mirror",
    "run_stored_mirror",
]
