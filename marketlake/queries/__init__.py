"""Registered queries over the driver tables, each with its SQL twin where SQL can say it."""

from marketlake.queries import datasets, landed, loads, measures, payloads, planning, shaping, writing  # noqa: F401  (they register)
from marketlake.queries.base import REGISTRY, Tables

__all__ = ["REGISTRY", "Tables"]
