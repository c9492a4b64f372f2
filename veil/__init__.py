"""De-identification and profiling of large tables on Spark."""

from veil.operators.chains import apply_chain, register_op
from veil.plans.reports import (
    compare_frequencies,
    dataset_counts,
    distribution_report,
    frequencies,
    frequency,
    sample_compare,
    survey,
)
from veil.plans.runner import run_jobs
from veil.plans.steps import deidentify, ingest, prepare, publish

__all__ = [
    "apply_chain",
    "compare_frequencies",
    "dataset_counts",
    "deidentify",
    "distribution_report",
    "frequencies",
    "frequency",
    "ingest",
    "prepare",
    "publish",
    "register_op",
    "run_jobs",
    "sample_compare",
    "survey",
]
