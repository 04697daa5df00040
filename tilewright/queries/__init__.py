"""Registered queries over the driver's tables, one per operator, with their DuckDB SQL."""

from . import boxes, lonlat, relations, shapes, surfaces, texts
from .base import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES", "boxes", "lonlat", "relations", "shapes", "surfaces", "texts"]
