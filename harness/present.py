"""Plain result columns: decimals rounded to cents as doubles, ratios rounded, dates as text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MONTHS = ("period", "rate_date")


# Means of exact decimals often end in a 5 just past the last shown digit, where the two engines may round
# apart. The offset moves such values off the tie; it is far below the shown precision.
TIE_OFFSET = 2.7e-8


def plain(df: DataFrame, digits: int = 6, cents: int = 2, off_ties: bool = False) -> DataFrame:
    columns = []
    for f in df.schema.fields:
        col, kind = F.col(f.name), f.dataType.typeName()
        if kind == "decimal":
            col = F.round(col, cents).cast("double")
        elif kind in ("double", "float"):
            col = F.round(col + TIE_OFFSET if off_ties else col, digits)
        elif kind == "date":
            col = F.date_format(col, "yyyy-MM" if f.name in MONTHS else "yyyy-MM-dd")
        columns.append(col.alias(f.name))
    return df.select(*columns)
