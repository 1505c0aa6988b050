"""Queries on the given tables. Importing a module registers its queries."""

from hazemart.bindings import analyses, ingest, learning, marts, recovery, streams, texts, values  # noqa: F401
from hazemart.bindings.registry import ORACLES, QUERIES  # noqa: F401
