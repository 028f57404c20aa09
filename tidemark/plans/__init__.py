"""Registered queries: each pairs a DataFrame plan with, where one exists, the SQL it must equal."""

from .registry import oracles, plans

__all__ = ["oracles", "plans"]
