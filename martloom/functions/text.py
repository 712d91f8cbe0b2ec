"""Texts with names to fill in."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def fill(template: str, **values: Column | str) -> Column:
    """The template with each ``{name}`` replaced by its column or text; NULL if a column is."""
    parts = re.split(r"\{(\w+)\}", template)
    columns = []
    for i, part in enumerate(parts):
        value = values[part] if i % 2 else part
        columns.append(F.lit(value) if isinstance(value, str) else value)
    return F.concat(*columns)
