"""Registered queries and whole jobs."""

from headway.plans import (  # noqa: F401
    q_calendar,
    q_documents,
    q_job_tables,
    q_jobs,
    q_large,
    q_lifecycle,
    q_rollup,
    q_timetable,
    q_tracks,
)
from headway.plans.registry import ORACLES, QUERIES  # noqa: F401
