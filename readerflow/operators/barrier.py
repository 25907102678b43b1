"""Keep optimizer-inferred predicates from re-inlining expensive columns.

Predicates on a derived column (a user filter, or the ``isnotnull`` Catalyst
infers for a join key) are pushed below the projections that define it by
substituting the definition. For the staged text pipelines, whose stages each
reference the previous one several times, that substitution multiplies the
expression tree per stage. Computing the final columns inside a one-element
``inline_outer`` Generate stops the pushdown there: predicates on generator
output stay above it, and nothing else changes (one output row per input row).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def materialize(df: DataFrame, **cols: Column) -> DataFrame:
    """``df.withColumns(cols)`` behind a pushdown barrier.

    The expressions are computed in an ordinary projection (whole-stage
    codegen, common-subexpression elimination); the Generate above it only
    repackages the computed columns, and predicates on them stop there.
    """
    keep = [c for c in df.columns if c not in cols]
    tmp = {n: f"__m_{n}" for n in cols}
    computed = df.select(*keep, *[c.alias(tmp[n]) for n, c in cols.items()])
    packed = F.array(F.struct(*[F.col(tmp[n]).alias(n) for n in cols]))
    return computed.select(*keep, F.inline_outer(packed))
