"""Importing the package registers every query."""

from . import cleaning, featured, gaps, isolated, joined, modelled, sourced, streamed, summary  # noqa: F401
from .base import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
