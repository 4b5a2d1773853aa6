from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Key parts are joined by a dash, a missing part is spelled out.
KEY_SEPARATOR = "-"
MISSING_PART = "_dbt_utils_surrogate_key_null_"


def surrogate_key(*parts: str) -> Column:
    spelled = [F.coalesce(F.col(p).cast("string"), F.lit(MISSING_PART)) for p in parts]
    return F.md5(F.concat_ws(KEY_SEPARATOR, *spelled))
