"""Binding of logical fields to the user's column names."""

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


class MappingError(ValueError):
    """A mapped field is absent or ambiguous."""


def resolve(columns: Iterable[str], wanted: str) -> str | None:
    """The column that equals the wanted name but for case; None if there is none."""
    hits = [c for c in columns if c.lower() == wanted.lower()]
    if len(hits) > 1:
        raise MappingError(f"columns differ only in case: {', '.join(sorted(hits))}")
    return hits[0] if hits else None


def bind_fields(
    df: DataFrame,
    types: Mapping[str, T.DataType],
    mapping: Mapping[str, str] | None = None,
    optional: Iterable[str] = (),
    keep: Mapping[str, str] | None = None,
) -> DataFrame:
    """Selects the target fields by their source names and hides all other columns.

    mapping gives target -> source where they differ. keep gives further columns
    (ids, geometry) as target -> source, with their type unchanged. An absent optional
    field becomes NULL; all other absent fields are reported together.
    """
    mapping = dict(mapping or {})
    unknown = [t for t in mapping if t not in types]
    if unknown:
        raise MappingError(f"unknown target fields: {', '.join(unknown)}")
    missing, selected = [], []
    for target, source in (keep or {}).items():
        found = resolve(df.columns, source)
        if found is None:
            missing.append(source)
        else:
            selected.append(F.col(f"`{found}`").alias(target))
    for target, dtype in types.items():
        source = mapping.get(target, target)
        found = resolve(df.columns, source)
        if found is not None:
            selected.append(_typed(F.col(f"`{found}`"), dtype).alias(target))
        elif target in optional:
            selected.append(F.lit(None).cast(dtype).alias(target))
        else:
            missing.append(source)
    if missing:
        raise MappingError(f"columns not found: {', '.join(missing)}")
    return df.select(*selected)


def _typed(column: Column, dtype: T.DataType) -> Column:
    return column.cast(dtype) if isinstance(dtype, T.StringType) else column.try_cast(dtype)


def text_to_int(column: Column | str) -> Column:
    """Whole number from text, NULL where the text is not one."""
    column = F.col(column) if isinstance(column, str) else column
    return column.try_cast("bigint")


def failed_cast(df: DataFrame, types: Mapping[str, T.DataType], mapping=None) -> dict[str, Column]:
    """For each bound field that is not text: how many values its type cannot hold."""
    counts = {}
    for target, dtype in types.items():
        found = resolve(df.columns, (mapping or {}).get(target, target))
        if found is None or isinstance(dtype, T.StringType):
            continue
        value = F.col(f"`{found}`")
        lost = value.isNotNull() & value.try_cast(dtype).isNull()
        counts[target] = F.coalesce(F.sum(lost.cast("bigint")), F.lit(0))
    return counts
