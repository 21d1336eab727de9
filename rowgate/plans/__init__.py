from rowgate.plans.jobs import CleanseJob, IngestJob
from rowgate.plans.scoring import bad, good, reason_counts, score

__all__ = ["CleanseJob", "IngestJob", "bad", "good", "reason_counts", "score"]
