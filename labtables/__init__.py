"""Curated laboratory datasets as Spark DataFrame plans."""

from labtables.config import get_session

__all__ = ["get_session"]
