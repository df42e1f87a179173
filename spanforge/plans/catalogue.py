"""Importing this module fills the query catalogue."""

from . import (  # noqa: F401
    candidate_queries,
    fingerprint_queries,
    graph_queries,
    hit_queries,
    interval_queries,
    reader_queries,
    region_queries,
    report_queries,
    sequence_queries,
)
from .registry import QUERIES, SQL  # noqa: F401
