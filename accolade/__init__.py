"""Accolade: guest-recognition analytics as plain PySpark DataFrame operators."""

from accolade.policy import Policy

__all__ = ["Policy"]
