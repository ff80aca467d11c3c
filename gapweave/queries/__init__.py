"""The query catalogue; importing the modules fills the registry."""

from gapweave.queries import corpus, evaluation, training  # noqa: F401
from gapweave.queries.registry import ORACLES, QUERIES

__all__ = ["QUERIES", "ORACLES"]
