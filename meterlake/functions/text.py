"""Text renderings of values as the meters publish them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def iso_utc_text(ts: Column) -> Column:
    """ISO-8601 text with a ``Z`` suffix, microseconds only when non-zero.

    This is how a Python producer prints ``datetime.isoformat() + "Z"``.
    """
    whole = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    frac = F.date_format(ts, "SSSSSS")
    return F.when(ts.isNull(), F.lit(None)).otherwise(
        F.concat(whole, F.when(frac == "000000", F.lit("")).otherwise(F.concat(F.lit("."), frac)), F.lit("Z"))
    )
