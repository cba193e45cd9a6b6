"""All registered queries."""

from fernwick.plans.catalog import (
    code, features, files, metrics, modelling, ordered, relational, stores, texts, vectors,
)
from fernwick.plans.catalog.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL", "code", "features", "files", "metrics", "modelling", "ordered", "relational", "stores", "texts",
           "vectors"]
