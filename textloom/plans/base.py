"""The registry of the library's own queries."""

from __future__ import annotations

from textloom.registry import Registry

REGISTRY = Registry()
query = REGISTRY.query
