"""Needs of a step as part of its plan: the job that reads a row that doesn't meet them fails with their name."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.sources.io import require_columns


def checked(df: DataFrame, what: str, not_null: list[str] = (), holds: dict[str, Column] | None = None) -> DataFrame:
    """``df``, whose columns ``not_null`` hold no null and whose rows meet each condition of ``holds`` {name: condition}.

    A column that is missing is named at once (ValueError).  Rows are looked at
    when a job reads them, in the same pass: the first that has a null, or
    whose condition is false or null, fails the job and names ``what``, the
    need, and nothing else of the row.  A need is tied to the first column of
    ``not_null``, so steps that read that column can't skip it; without such a
    column conditions need ``holds`` only, tied to the first column of ``df``.
    """
    require_columns(df, list(not_null), what)
    first = list(not_null)[0] if not_null else df.columns[0]
    bad = [(F.col(f"`{c}`").isNull(), f"{what}: {c} is null") for c in not_null]
    bad += [(~F.coalesce(cond, F.lit(False)), f"{what}: not so: {name}") for name, cond in (holds or {}).items()]
    value = F.col(f"`{first}`")
    for is_bad, why in reversed(bad):
        value = F.when(is_bad, F.raise_error(F.lit(why)).cast(df.schema[first].dataType)).otherwise(value)
    return df.select(*[value.alias(c) if c == first else F.col(f"`{c}`") for c in df.columns])
