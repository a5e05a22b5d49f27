"""Readers and writers for the order tables."""

from basketry.sources.tables import Tables  # noqa: F401
