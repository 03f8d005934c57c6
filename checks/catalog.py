"""All registered queries; importing the modules registers them."""

from checks import features, operators  # noqa: F401
from checks.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
