"""Queries composed from the operators, and their equivalent SQL."""

from . import cleaning, evaluation, filling, relational, spatial, storage, timeline
from .catalog import QUERIES, SQL

__all__ = ["QUERIES", "SQL", "cleaning", "evaluation", "filling", "relational", "spatial", "storage", "timeline"]
