"""Contract queries; importing the package registers them all."""

from kamienica.contract import cleansing, extraction, features, models, profiling, sources  # noqa: F401
from kamienica.contract.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
