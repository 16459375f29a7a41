"""Pages of an ordered table."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PAGE_SIZE = 18


def as_number(value: object, default: int) -> int:
    """Leading integer of a request parameter; ``default`` for none or zero."""
    found = re.match(r"\s*([+-]?\d+)", str(value)) if value is not None else None
    return (int(found.group(1)) if found else 0) or default


def page_of(
    df: DataFrame,
    page: object = 1,
    limit: object = PAGE_SIZE,
    order_by: str = "_id",
    after: str | None = None,
) -> DataFrame:
    """Rows ``(page - 1) * limit`` onwards in ``order_by`` order.

    Each task keeps its ``offset + limit`` first rows and these are merged. A reader
    that walks far into a table should pass the last key seen as ``after``: then the
    filter reaches the scan and no page costs more than the first one.
    """
    number, size = as_number(page, 1), as_number(limit, PAGE_SIZE)
    if number < 1 or size < 1:
        raise ValueError("page and limit must be positive")
    if after is not None:
        return df.filter(F.col(order_by) > after).orderBy(order_by).limit(size)
    return df.orderBy(order_by).offset((number - 1) * size).limit(size)


def page_count(total: Column, size: int = PAGE_SIZE) -> Column:
    return F.ceil(total / F.lit(size)).cast("long")


def clamp_page(requested: Column, pages: Column) -> Column:
    """A requested page (text or number) moved into ``1 .. pages``."""
    digits = F.regexp_extract(requested.cast("string"), r"^\s*([+-]?\d+)", 1)
    number = digits.try_cast("long")
    # More digits than a long has: beyond the last page, unless negative.
    beyond = number.isNull() & digits.rlike(r"^[+]?\d+$")
    wanted = F.when(beyond, pages.cast("long")).otherwise(
        F.coalesce(F.when(number >= 1, number), F.lit(1))
    )
    return F.least(wanted, pages.cast("long"))
