"""Spark-native ingestion, cleaning, aggregation and learning for dated, located event records."""

from sedimark.profile import INCIDENTS, RecordProfile
from sedimark.session import build_session, shared_folder

__all__ = ["INCIDENTS", "RecordProfile", "build_session", "shared_folder"]
