"""Land raw files, check every row against a contract, split clean rows from quarantine."""

from rowgate.contract import Contract, dynamic, framework, standard
from rowgate.plans import CleanseJob, IngestJob, bad, good, reason_counts, score
from rowgate.staging import Staging, fixed_splits

__all__ = [
    "CleanseJob",
    "Contract",
    "IngestJob",
    "Staging",
    "bad",
    "dynamic",
    "fixed_splits",
    "framework",
    "good",
    "reason_counts",
    "score",
    "standard",
]
