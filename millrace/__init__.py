"""millrace: Spark operators for the data side of machine learning."""

from millrace.session import build_session, configure

__all__ = ["build_session", "configure"]
