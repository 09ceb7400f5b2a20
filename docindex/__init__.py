"""Incremental document index as DataFrame operators."""

from docindex.config import IndexConfig
from docindex.plans.increment import RunReport, index_directory, run_increment
from docindex.sources.store import IndexStore

__all__ = ["IndexConfig", "IndexStore", "RunReport", "index_directory", "run_increment"]
