"""Whole jobs in batch mode."""

from vectorferry.plans.job import MigrationJob, check_job, migrate, to_target, verify

__all__ = ["MigrationJob", "check_job", "migrate", "to_target", "verify"]
