"""String column functions (O-48, O-50, O-18 helper)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Python's str.strip() removes Unicode white space plus the four ASCII
# separator controls \x1c-\x1f; Spark's trim() only removes spaces.
_WS = r"[\s\x{1c}-\x{1f}]"
_STRIP_RE = rf"(?U)^{_WS}+|{_WS}+$"


def ustrip(c: Column) -> Column:
    """Strip leading/trailing Unicode white space (O-50)."""
    return F.regexp_replace(c, _STRIP_RE, "")


def split_trim(c: Column, sep: str = ",") -> Column:
    """Split a delimited list and strip every item (O-48)."""
    return F.transform(F.split(c, sep), lambda x: ustrip(x))


def contains_ci(c: Column, needle: str) -> Column:
    """Case-insensitive substring test; null input gives false."""
    return F.coalesce(F.lower(c).contains(needle.lower()), F.lit(False))
