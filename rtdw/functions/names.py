"""Column naming: snake_case to camelCase and back, for frames and for map keys."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def camel_name(name: str) -> str:
    head, *rest = name.lower().split("_")
    return head + "".join(part.capitalize() for part in rest)


def snake_name(name: str) -> str:
    return re.sub("([A-Z])", r"_\1", name).lower().lstrip("_")


def camel_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*map(camel_name, df.columns))


def snake_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*map(snake_name, df.columns))


def camel_keys(data: Column | str) -> Column:
    """Rename the keys of a map to camelCase."""

    def rename(key: Column, _value: Column) -> Column:
        parts = F.split(F.lower(key), "_")
        return F.concat(parts[0], F.array_join(F.transform(F.slice(parts, 2, F.size(parts)), F.initcap), ""))

    return F.transform_keys(data, rename)
