"""Imports every query module so that the registry is complete."""

from . import q_analysis, q_catalog, q_integration, q_interpret, q_model, q_stream  # noqa: F401
from .registry import ORACLE, QUERIES  # noqa: F401
