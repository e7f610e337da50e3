"""Importing this module registers every query."""

from catalog import business, checks, fleet, prices, streams, texts  # noqa: F401
