"""Traffic-cohort analytics on Spark: ingest, cohort features, scores, reports."""

from clickcohort.params import Params

__all__ = ["Params"]
__version__ = "0.1.0"
