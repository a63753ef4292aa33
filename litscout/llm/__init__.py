"""Operators that prepare large text collections for training, one module per problem.

Nothing outside this subpackage imports it. queries() and oracle_sql() list what its modules register.
"""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

MODULES = ("language", "fusion", "formatting", "canonical", "linkage", "matching", "leakage", "mixture", "residue")


def _modules():
    return [importlib.import_module(f"{__name__}.{name}") for name in MODULES]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: query for module in _modules() for name, query in module.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for module in _modules() for name, sql in module.ORACLES.items()}
