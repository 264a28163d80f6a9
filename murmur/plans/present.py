"""Output presentation shared by every registered query.

Results are compared across engines, so the last projection pins types: doubles
rounded to 6 decimals, timestamps as ISO text, small ints widened to BIGINT.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DIGITS = 6
TS_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def present(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    out = []
    for name, dtype in df.dtypes:
        c = F.col(f"`{name}`")
        if dtype in ("double", "float"):
            c = F.round(c.cast("double"), digits)
        elif dtype == "timestamp_ntz":
            c = F.date_format(c, TS_FORMAT)
        elif dtype.startswith("timestamp"):
            c = F.date_format(c.cast("timestamp_ntz"), TS_FORMAT)
        elif dtype == "date":
            c = F.date_format(c, "yyyy-MM-dd")
        elif dtype in ("int", "smallint", "tinyint"):
            c = c.cast("long")
        out.append(c.alias(name))
    return df.select(*out)
