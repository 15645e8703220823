"""Projection of source rows onto a target table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def project_mapping(
    df: DataFrame,
    target: StructType,
    mapping: Mapping[str, str],
    more: Mapping[str, Column] | None = None,
) -> DataFrame:
    """``target <- source`` columns in target order and type; the unmapped ones are NULL.

    ``more`` are columns that follow them.
    """
    unknown = set(mapping) - set(target.names)
    if unknown:
        raise ValueError(f"not columns of the target: {sorted(unknown)}")
    return df.select(
        *(
            (F.col(mapping[f.name]) if f.name in mapping else F.lit(None))
            .cast(f.dataType)
            .alias(f.name)
            for f in target
        ),
        *(column.alias(name) for name, column in (more or {}).items()),
    )
