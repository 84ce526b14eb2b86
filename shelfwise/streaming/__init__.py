"""Incremental (available-now) ingestion of report files into the tables."""

from .ingest import ads_report_stream, analytics_response_stream, append_new_files
from .pulls import ads_pulls, analytics_pulls, land_pulls, read_days

__all__ = ["ads_report_stream", "analytics_response_stream", "append_new_files",
           "ads_pulls", "analytics_pulls", "land_pulls", "read_days"]
