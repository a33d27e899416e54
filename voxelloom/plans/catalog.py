"""All registered queries of the engine and their SQL."""

from __future__ import annotations

from . import more_queries  # noqa: F401  registers its queries
from .volume_queries import ORACLES, QUERIES

FLAGSHIP = "px_8bit_block_max"

__all__ = ["FLAGSHIP", "ORACLES", "QUERIES"]
