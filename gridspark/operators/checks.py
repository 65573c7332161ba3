"""Declared columns against actual data."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from gridspark.operators.latest import require_columns
from gridspark.spec import ColumnSpec


def contract_violations(df: DataFrame, columns: Sequence[ColumnSpec]) -> DataFrame:
    """(column_name, violations): NULLs found per column declared non-null, in one pass."""
    required = [c.name for c in columns if not c.nullable]
    require_columns(df, [c.name for c in columns], "declared columns")
    if not required:
        raise ValueError("no column is declared non-null")
    counts = df.agg(*[F.count_if(F.col(f"`{n}`").isNull()).alias(n) for n in required])
    return counts.unpivot([], required, "column_name", "violations")


class ContractViolation(ValueError):
    """Rows to write have NULLs in columns that are declared non-null; `counts` says how many."""

    def __init__(self, counts: dict[str, int]):
        self.counts = counts
        super().__init__(f"NULLs in non-null columns: { {k: v for k, v in counts.items() if v} }")


def observed(df: DataFrame, columns: Sequence[ColumnSpec]) -> tuple[DataFrame, Observation | None]:
    """`df` that counts, while it is written, NULLs per column declared non-null; no scan of its own."""
    required = [c.name for c in columns if not c.nullable]
    if not required:
        return df, None
    require_columns(df, required, "declared columns")
    counts = Observation(f"contract-{uuid.uuid4().hex}")
    return df.observe(counts, *[F.count_if(F.col(f"`{n}`").isNull()).alias(n) for n in required]), counts


def assert_kept(counts: Observation | None) -> None:
    """Raise if what was written broke the contract; for callers that have not put it in place yet."""
    if counts is not None and any(counts.get.values()):
        raise ContractViolation({name: int(n) for name, n in counts.get.items()})


def assert_unique(df: DataFrame, keys: Sequence[str]) -> None:
    """Raise if two rows share a key (NULLs count as equal)."""
    repeated = df.groupBy(*[F.col(f"`{k}`") for k in keys]).count().where("count > 1")
    sample = repeated.limit(1).collect()
    if sample:
        raise ValueError(f"rows to write repeat the key {sample[0].asDict()}")
