"""Every operator run over the driver's tables, each next to the SQL that says the same."""

from __future__ import annotations

from lotewise.registry import (  # noqa: F401
    audit,
    coordinates,
    incremental,
    layout,
    load,
    normalisation,
    photos,
    selection,
    whole,
)
from lotewise.registry.base import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
