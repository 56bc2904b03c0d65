"""Named queries over the standard tables, each with its SQL counterpart."""

from auditlark.catalog.registry import QUERIES, load_all

__all__ = ["QUERIES", "load_all"]
