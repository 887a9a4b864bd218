from .cohort import cohort_exact, cohort_sketch, time_bucket, weekly_cohort

__all__ = ["cohort_exact", "cohort_sketch", "time_bucket", "weekly_cohort"]
