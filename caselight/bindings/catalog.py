"""All registered queries; importing the modules fills the registry."""

from caselight.bindings import queries_monitors, queries_reports, queries_sources, queries_triage  # noqa: F401
from caselight.bindings.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
