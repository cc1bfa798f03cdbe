"""Jobs: restartable stages, the one-shot job, and the query catalogue."""

from .catalog import ORACLE_SQL, QUERIES
from .staged import STAGES, TIMELINE_FORMS, run_once, run_stage, stage_compute, stage_read, stage_save, stage_sort

__all__ = [
    "ORACLE_SQL",
    "QUERIES",
    "STAGES",
    "TIMELINE_FORMS",
    "run_once",
    "run_stage",
    "stage_compute",
    "stage_read",
    "stage_save",
    "stage_sort",
]
