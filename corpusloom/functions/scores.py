"""Number rules as Column functions: bands, clamps, ratios and masks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Names of the bands and the order of ranks.
BANDS = {"substantive": 3, "moderate": 2, "boilerplate": 1}
GOVERNANCE = {"none": 0.0, "basic": 0.33, "intermediate": 0.66, "advanced": 1.0}
MATERIALITY = {"unspecified": 0, "low": 1, "medium": 2, "high": 3}


def lookup(value: Column, table: dict, default: object = None) -> Column:
    found = F.try_element_at(F.create_map(*[F.lit(x) for kv in table.items() for x in kv]), value)
    return found if default is None else F.coalesce(found, F.lit(default))


def unit(score: Column, top: float = 3.0) -> Column:
    return F.least(F.greatest(score / top, F.lit(0.0)), F.lit(1.0))


def signal_level(signal: Column) -> Column:
    """0 to 3: below 1 by thirds, from 1 on rounded half up and kept in 1 to 3."""
    low = F.when(signal >= 0.67, 3).when(signal >= 0.34, 2).when(signal > 0, 1).otherwise(0)
    return F.when(signal < 1, low).otherwise(F.least(F.greatest(F.floor(signal + 0.5), F.lit(1)), F.lit(3)).cast("int"))


def substantiveness(value: Column) -> Column:
    """A band from its name, a score in 0 to 1 by thirds, or a score to 3 rounded half to even."""
    number = value.try_cast("double")
    high = F.bround(number, 0)
    by_number = F.when(number <= 1, F.when(number >= 0.67, "substantive").when(number >= 0.34, "moderate").otherwise("boilerplate"))
    by_number = by_number.otherwise(F.when(high >= 3, "substantive").when(high >= 2, "moderate").otherwise("boilerplate"))
    name = F.lower(F.trim(value.cast("string")))
    return F.when(number.isNotNull(), by_number).when(name.isin(*BANDS), name)


def review_priority(confidence: Column) -> Column:
    return F.when(confidence < 0.7, "high").when(confidence < 0.85, "medium").otherwise("low")


def ratio(part: Column, whole: Column, default: float = 0.0) -> Column:
    return F.when(whole > 0, part / whole).otherwise(default)


def label_mask(labels: Column, vocabulary: Sequence[str]) -> Column:
    """Bit i is set if label i of the vocabulary is in the array; other labels are ignored."""
    return sum((F.when(F.array_contains(labels, v), 1 << i).otherwise(0).cast("long") for i, v in enumerate(vocabulary)), F.lit(0).cast("long"))


def has_bit(mask: Column, i: int) -> Column:
    return mask.bitwiseAND(F.lit(1 << i)) != 0
