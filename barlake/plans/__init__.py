"""The five medallion jobs as callables with arguments."""

from barlake.plans.jobs import (
    bronze_bars_job,
    bronze_info_job,
    gold_metrics_job,
    gold_metrics_frame,
    gold_source,
    silver_bars_job,
    silver_profile_job,
)

__all__ = [
    "bronze_bars_job",
    "bronze_info_job",
    "gold_metrics_frame",
    "gold_metrics_job",
    "gold_source",
    "silver_bars_job",
    "silver_profile_job",
]
