"""Event-log quality audits and freight-operations reports as Spark DataFrame jobs."""

from haulmetry.session import build_session, tune

__all__ = ["build_session", "tune"]
