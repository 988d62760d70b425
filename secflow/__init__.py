"""secflow: security-event analytics expressed as Spark DataFrame operators."""

from secflow.session import configure

__all__ = ["configure"]
