"""Missing values and defaults."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from ..functions.text import nan_to_null


def nan_as_null(rows: DataFrame) -> DataFrame:
    """NaN of every floating column becomes NULL."""
    floating = [f.name for f in rows.schema.fields if isinstance(f.dataType, (DoubleType, FloatType))]
    return rows.withColumns({name: nan_to_null(F.col(name)) for name in floating})


def fill_defaults(rows: DataFrame, numbers: dict[str, float], texts: tuple[str, ...] = (),
                  flags: tuple[str, ...] = (), text_default: str = "") -> DataFrame:
    """Per-column numeric defaults, one text default, false for flags."""
    filled = {name: F.coalesce(F.col(name), F.lit(value)) for name, value in numbers.items()}
    filled |= {name: F.coalesce(F.col(name), F.lit(text_default)) for name in texts}
    filled |= {name: F.coalesce(F.col(name), F.lit(False)) for name in flags}
    return rows.withColumns(filled)
