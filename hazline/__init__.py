"""Hazard-zone / element-at-risk overlay and risk measures on Spark DataFrames."""

from hazline.plans.study import StudyResult, run_study
from hazline.sinks.store import StudyStore

__all__ = ["StudyResult", "StudyStore", "run_study"]
