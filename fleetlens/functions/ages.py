"""Age categories: one function, three sets of limits."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values: (upper bound, exclusive; name). The last entry has no bound.
PRODUCTION = [(3, "new"), (7, "mid_life"), (None, "aged")]
LIFE_STAGE = [(7, "young"), (12, "midlife"), (17, "mature"), (None, "aging")]
PROTOTYPE = [(5, "young"), (12, "mid"), (None, "old")]


def age_category(age: Column, limits=PRODUCTION) -> Column:
    result = None
    for bound, name in limits:
        if bound is None:
            # A missing age falls through every comparison to the last name.
            return F.lit(name) if result is None else result.otherwise(F.lit(name))
        result = F.when(age < bound, name) if result is None else result.when(age < bound, name)
    return result


def category_order(name: Column, limits) -> Column:
    """Position of a category, for sorting by life stage."""
    order = None
    for position, (_, label) in enumerate(limits, start=1):
        order = F.when(name == label, position) if order is None else order.when(name == label, position)
    return order
