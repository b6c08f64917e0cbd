"""Whole runs: from landed responses to current tables."""

from sharefold.plans.cleanup import forget
from sharefold.plans.ingest import FeedRun, ingest, ingest_all, ingest_crawls, replay_rejects, run_metrics, stage_feed

__all__ = ["FeedRun", "forget", "ingest", "ingest_all", "ingest_crawls", "replay_rejects", "run_metrics", "stage_feed"]
