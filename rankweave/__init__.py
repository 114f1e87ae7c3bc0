"""Link ranking, inverted indexing and keyword search as Spark DataFrame jobs."""

from rankweave.plans.jobs import build_index, link_rank, search

__all__ = ["build_index", "link_rank", "search"]
