"""All registered queries; importing the plan modules fills the registry."""

from kymo.plans import contracts, grouped, model, ordered, scoring, tabular  # noqa: F401
from kymo.plans.base import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
