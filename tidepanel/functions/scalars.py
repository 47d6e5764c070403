"""Column expressions on dates, numbers and ids."""

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def day_of_week(day: Column) -> Column:
    """Monday 0 to Sunday 6."""
    return F.weekday(day)


def fourier_weekly(day: Column, k: int) -> tuple[Column, Column]:
    angle = F.lit(2.0 * math.pi * k) * F.weekday(day) / 7.0
    return F.sin(angle), F.cos(angle)


def fourier_annual(day: Column, k: int) -> tuple[Column, Column]:
    angle = F.lit(2.0 * math.pi * k) * F.dayofyear(day) / 365.25
    return F.sin(angle), F.cos(angle)


def clip_lower(value: Column, bound: float | None = 0.0) -> Column:
    """``value`` but not below ``bound``; NULL stays NULL, which plain greatest() would turn into the bound."""
    if bound is None:
        return value
    return F.when(value.isNotNull(), F.greatest(value, F.lit(float(bound))))


def clip_upper(value: Column, bound: Column) -> Column:
    return F.when(value.isNotNull(), F.least(value, bound))


def ratio(top: Column, bottom: Column) -> Column:
    """top / bottom, NULL when bottom is 0 or NULL."""
    return F.try_divide(top, bottom)


def pct_improvement(default: Column, tuned: Column) -> Column:
    return ratio(default - tuned, default) * 100.0


def hierarchy_parts(uid: Column) -> dict[str, Column]:
    """The levels inside a ``CATEGORY_DEPT_ITEM_STATE_STORE`` id."""
    parts = F.split(uid, "_")
    return {
        "cat_id": F.get(parts, F.lit(0)),
        "dept_id": F.array_join(F.slice(parts, 1, 2), "_"),
        "state_id": F.get(parts, F.lit(3)),
        "store_id": F.array_join(F.slice(parts, 4, 2), "_"),
    }


def series_key(item: Column, store: Column) -> Column:
    """item_store; NULL if either part is NULL."""
    return F.concat(item, F.lit("_"), store)
