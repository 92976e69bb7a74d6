"""Schemas, derivation of the retail tables, ingest and sinks."""

from .derive import RetailTables, derive_retail, derive_orders, derive_lines, derive_products
from .tables import load_retail, materialize, register_views

__all__ = ["RetailTables", "derive_retail", "derive_orders", "derive_lines", "derive_products",
           "load_retail", "materialize", "register_views"]
