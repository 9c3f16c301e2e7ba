"""All registered queries: importing the query modules fills the registry."""

from __future__ import annotations

from . import eval_queries, feature_queries, label_queries, message_queries, model_queries, split_queries  # noqa: F401
from .registry import REGISTRY, SQL


def queries():
    return dict(REGISTRY)


def oracle_sql():
    return {k: v for k, v in SQL.items() if k in REGISTRY}
