"""Nested JSON and document layouts to tables, as lazy PySpark DataFrames."""

from nestweave.entities import CONVERSATIONS, TICKETS, Entity

__all__ = ["CONVERSATIONS", "TICKETS", "Entity"]
