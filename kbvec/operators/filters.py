"""Filter documents ``{field: {op: value}}`` to one Column predicate."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

# Filter fields and the columns they address.
FIELDS = {
    "type": "content_type",
    "content_type": "content_type",
    "role_restriction": "role_restriction",
    "source_url": "source_url",
    "chunk_index": "chunk_index",
}

OPERATORS = {
    "$eq": lambda c, v: c == F.lit(v),
    "$ne": lambda c, v: c != F.lit(v),
    "$gt": lambda c, v: c > F.lit(v),
    "$gte": lambda c, v: c >= F.lit(v),
    "$lt": lambda c, v: c < F.lit(v),
    "$lte": lambda c, v: c <= F.lit(v),
    "$in": lambda c, v: c.isin(*v),
    "$nin": lambda c, v: ~c.isin(*v),
}
LIST_OPERATORS = ("$in", "$nin")


def compile_filter(spec: Mapping[str, Any] | None) -> tuple[Column | None, list[str]]:
    """The AND of every clause, and the names of the clauses that were ignored.

    Unknown fields and operators are ignored, and so are empty lists; a null column value matches no
    clause, as in SQL. The predicate is made of plain comparisons, so it reaches the Parquet scan.
    """
    clauses, ignored = [], []
    for field, ops in (spec or {}).items():
        if field not in FIELDS or not isinstance(ops, Mapping):
            ignored.append(f"field:{field}")
            continue
        for op, value in ops.items():
            if op not in OPERATORS:
                ignored.append(f"operator:{field}.{op}")
            elif op in LIST_OPERATORS and not (isinstance(value, (list, tuple)) and value):
                ignored.append(f"empty:{field}.{op}")
            else:
                clauses.append(OPERATORS[op](F.col(FIELDS[field]), value))
    return (reduce(lambda a, b: a & b, clauses) if clauses else None), ignored


def tenant_rows(vectors, tenant: str, spec: Mapping[str, Any] | None = None):
    """Rows of one tenant that pass the filter document."""
    predicate, _ = compile_filter(spec)
    rows = vectors.filter(F.col("bot_id") == F.lit(tenant))
    return rows if predicate is None else rows.filter(predicate)
