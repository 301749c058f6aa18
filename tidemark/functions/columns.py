"""Column references by exact name."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(name: str) -> Column:
    """Column named exactly ``name``: dots, spaces and backticks are not parsed.

    Attribute names of items may contain any of them (``user.id``, ``a b``).
    """
    return F.col("`" + name.replace("`", "``") + "`")
