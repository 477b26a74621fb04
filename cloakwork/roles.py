"""Column roles of a microdata table and small schema helpers."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import types as T


@dataclass(frozen=True)
class AnonSpec:
    """Which columns identify a person, which generalize, which stay as they are.

    ``qi`` is ordered: ties between equally wide columns go to the earlier one.
    ``categorical`` lists the QI columns that are coded before partitioning.
    """

    qi: tuple[str, ...]
    sa: str
    identifiers: tuple[str, ...] = ()
    categorical: tuple[str, ...] = ()
    k: int = 5
    strict: bool = True
    delimiter: str = "~"
    weights: dict[str, float] = field(default_factory=dict)

    @property
    def numeric(self) -> tuple[str, ...]:
        return tuple(c for c in self.qi if c not in self.categorical)

    def project(self, df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
        """Identifiers removed, quasi-identifiers in order, sensitive attribute last."""
        return df.select(*keep, *self.qi, self.sa)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]


def dtype_histogram(df: DataFrame) -> dict[str, int]:
    out: dict[str, int] = {}
    for _, kind in df.dtypes:
        out[kind] = out.get(kind, 0) + 1
    return out


def is_categorical(
    name: Column, n_distinct: Column, forced: tuple[str, ...] = (), exempt: tuple[str, ...] = (), below: int = 10
) -> Column:
    """Forced columns, plus the others with fewer than ``below`` distinct values."""
    few = n_distinct < below
    if exempt:
        few = few & ~name.isin(*exempt)
    return name.isin(*forced) | few if forced else few


def bound_columns(available: list[str], numeric: list[str]) -> list[str]:
    """Each numeric column itself, or its ``_min``/``_max`` pair after recoding."""
    out: list[str] = []
    for c in numeric:
        if c in available:
            out.append(c)
        elif f"{c}_min" in available and f"{c}_max" in available:
            out += [f"{c}_min", f"{c}_max"]
    return out
