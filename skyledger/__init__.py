"""Air-traffic analytics as PySpark DataFrame jobs."""

from skyledger.plans.delays import delay_stats
from skyledger.plans.fleet import least_flown_models, top_models_per_airline
from skyledger.plans.top_models import model_counts, top_models
from skyledger.session import build_session

__all__ = [
    "build_session",
    "delay_stats",
    "least_flown_models",
    "model_counts",
    "top_models",
    "top_models_per_airline",
]
