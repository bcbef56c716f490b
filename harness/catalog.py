"""Imports every query module so that the registry is complete."""

from harness import q_forecast, q_quality, q_statements  # noqa: F401
from harness.registry import ORACLES, QUERIES  # noqa: F401
