"""Imports every query module so that the registry is complete."""

from vitalframe.plans import q_basic, q_clinical, q_io, q_model, q_phases, q_rules  # noqa: F401
from vitalframe.plans.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
