"""orrery: catalogue-and-ratings analytics as Spark DataFrame jobs.

Layers: raw landing -> typed silver -> validated star schema (published as
versioned Parquet) -> recommendations -> dashboard analytics.
"""

from orrery.session import build_session, work_root

__all__ = ["build_session", "work_root"]
