"""All registered queries; importing the modules registers them."""

from trawl.plans import analysis, changing, decorating, fields, filtering, indexing, published, searching, states
from trawl.plans.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL", "analysis", "changing", "decorating", "fields", "filtering", "indexing", "published", "searching", "states"]
