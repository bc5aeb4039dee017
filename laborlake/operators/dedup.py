"""Deterministic keep-first de-duplication and duplicate counting.

``keep_first`` is an aggregate, not a window: ``min(struct(order..., rest...))``
per key. The aggregate is computed partially on the map side, so a key that
holds a third of all rows is collapsed to one row per map task before the
shuffle; a ``row_number`` window would send every row of that key to one task.
Null keys form one group, as in pandas ``drop_duplicates``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _q(name: str) -> str:
    return f"`{name}`"


def first_row_agg(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> tuple[Column, list[str]]:
    """Aggregate expression ``_first`` = the first row of a key group, and the packed column order."""
    order = [c for c in order if c not in keys]
    rest = [c for c in df.columns if c not in keys and c not in order]
    packed = order + rest
    pick = F.min(F.struct(*[F.col(_q(c)).alias(f"f{i}") for i, c in enumerate(packed)])).alias("_first")
    return pick, packed


def unpack_first(grouped: DataFrame, keys: Sequence[str], packed: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Key columns + the ``_first`` struct expanded back to ``columns`` (original order)."""
    by_name = {k: F.col(_q(k)) for k in keys}
    by_name.update({c: F.col(f"_first.f{i}").alias(c) for i, c in enumerate(packed)})
    return grouped.select(*[by_name[c] for c in columns])


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """One row per key: the first by ``order`` (ingest order), all other columns break ties."""
    keys = list(keys)
    if len(keys) == len(df.columns):
        return df.distinct()
    pick, packed = first_row_agg(df, keys, order)
    grouped = df.groupBy(*[F.col(_q(k)) for k in keys]).agg(pick)
    return unpack_first(grouped, keys, packed, df.columns)
