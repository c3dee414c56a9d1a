"""Categories derived from one value."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
AGE_BANDS = [
    (0, 25, "18-25"),
    (25, 35, "26-35"),
    (35, 45, "36-45"),
    (45, 55, "46-55"),
    (55, 65, "56-65"),
    (65, 100, "66+"),
]
MOBILE_WORDS = ["Mobile", "iPhone", "Android", "iPad"]
TRAFFIC_CATEGORIES = [
    (["Google", "Bing"], "Search Engine"),
    (["Facebook", "YouTube"], "Social Media"),
    (["Email"], "Email"),
]
OTHER_TRAFFIC = "Direct"


def age_band(age: Column) -> Column:
    """Band of an age, upper bound included; null outside all bands."""
    label = F.lit(None).cast("string")
    for low, high, name in AGE_BANDS:
        label = F.when((age > low) & (age <= high), F.lit(name)).otherwise(label)
    return label


def contains_any(text: Column, words: list[str]) -> Column:
    """True when the text holds one of the words; case counts."""
    return reduce(lambda a, b: a | b, [text.contains(w) for w in words])


def is_mobile_browser(browser: Column) -> Column:
    return contains_any(browser, MOBILE_WORDS)


def yes_no(flag: Column) -> Column:
    return F.when(flag, F.lit("Yes")).otherwise(F.lit("No"))


def traffic_source_category(source: Column) -> Column:
    """First category, in order, one of whose words the source holds."""
    (words, name), *rest = TRAFFIC_CATEGORIES
    chosen = F.when(contains_any(source, words), F.lit(name))
    for words, name in rest:
        chosen = chosen.when(contains_any(source, words), F.lit(name))
    return chosen.otherwise(F.lit(OTHER_TRAFFIC))


def flag_to_boolean(flag: Column) -> Column:
    return flag == F.lit("Y")
