"""The catalogue of queries; importing a module of queries adds its entries."""

from __future__ import annotations

from textloom.plans import captures, curation, fields, ordered, parsing, reconcile, retrieval, taxonomy, texts
from textloom.plans.base import REGISTRY

__all__ = ["REGISTRY", "captures", "curation", "fields", "ordered", "parsing", "reconcile", "retrieval", "taxonomy", "texts"]
