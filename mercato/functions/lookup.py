"""Dictionary lookups with a default, as literal map expressions.

A fixed lookup (a few dozen entries) becomes a ``map`` literal evaluated
inside whole-stage codegen: no join, no shuffle, no broadcast to size.
"""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F


def map_literal(mapping: dict, value_type: str | None = None) -> Column:
    pairs = []
    for k, v in mapping.items():
        val = F.lit(v)
        if value_type:
            val = val.cast(value_type)
        pairs.append((F.lit(k), val))
    if not pairs:
        return F.create_map()
    return F.create_map(*chain.from_iterable(pairs))


def lookup(key, mapping: dict, default, value_type: str | None = None) -> Column:
    """``mapping.get(key, default)``; a NULL or unknown key yields the default."""
    key_col = F.col(key) if isinstance(key, str) else key
    default_col = F.lit(default)
    if value_type:
        default_col = default_col.cast(value_type)
    return F.coalesce(F.try_element_at(map_literal(mapping, value_type), key_col), default_col)


def band(value, bands: list, top, value_type: str | None = None) -> Column:
    """First label whose upper bound exceeds the value; ``top`` above all."""
    v = F.col(value) if isinstance(value, str) else value
    expr = None
    for bound, label in bands:
        b = F.lit(bound)
        if value_type:
            b = b.cast(value_type)
        expr = F.when(v < b, F.lit(label)) if expr is None else expr.when(v < b, F.lit(label))
    return expr.otherwise(F.lit(top)) if expr is not None else F.lit(top)
