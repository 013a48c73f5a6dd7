"""Column helpers of the native operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Spaces as the data contracts have them: blank, and tab to carriage return.
SPACE = r"[\x20\x09-\x0D]"


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once for each row.

    A lambda variable can't be inlined into inner lambdas, where it would be
    computed again for each element.
    """
    return F.transform(F.array(value), use)[0]


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, f"{SPACE}+"), "")
