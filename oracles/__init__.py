"""Equivalent SQL for every registered query, on the base test tables."""

from oracles.queries import ORACLES  # noqa: F401
