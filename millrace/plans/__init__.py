from millrace.plans.batch import (
    STAGES,
    StageReport,
    ValidationError,
    backfill,
    restore,
    run_pipeline,
    take_back,
)
from millrace.plans.incremental import Flow, Folders, run_incremental

__all__ = [
    "STAGES",
    "Flow",
    "Folders",
    "StageReport",
    "ValidationError",
    "backfill",
    "restore",
    "run_incremental",
    "run_pipeline",
    "take_back",
]
