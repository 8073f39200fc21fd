"""All core queries; importing this module registers them."""

from . import analytics, general, pipeline, relational  # noqa: F401
from .registry import CORE

FLAGSHIP = "a05_coverage_audit"

__all__ = ["CORE", "FLAGSHIP"]
