"""Customer-lifecycle analytics for B2B software businesses, as Spark operators."""

from .policy import Policy

__all__ = ["Policy"]
