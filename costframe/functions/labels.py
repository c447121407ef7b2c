"""Key/value label arrays (`ARRAY<STRUCT<key,value>>`), kept as arrays: duplicate keys are legal."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _arr(labels) -> Column:
    return F.col(labels) if isinstance(labels, str) else labels


def label_value(key: str, labels="labels", strict: bool = False) -> Column:
    """Value of the label `key`; no match gives NULL.

    Two or more matches are an error in the warehouse dialect; by default the first match is
    taken, `strict=True` raises at run time instead. The place comes from `array_position` on the keys:
    compiled code without a lambda call per label, and the keys are taken out once per line however many
    labels a report wants.
    """
    arr = _arr(labels)
    first = F.get(arr["value"], F.array_position(arr["key"], key).cast("int") - 1)
    if not strict:
        return first
    return F.when(F.size(F.filter(arr, lambda x: x["key"] == F.lit(key))) > 1,
                  F.raise_error(F.lit(f"more than one label with key {key}"))).otherwise(first)


def has_label(key: str, labels="labels") -> Column:
    """`key IN (SELECT key FROM UNNEST(labels))` (three-valued, NULL array gives NULL)."""
    return F.array_contains(_arr(labels)["key"], key)


def lacks_label(key: str, labels="labels") -> Column:
    """`key NOT IN (SELECT key FROM UNNEST(labels))`.

    Empty or NULL array: TRUE. A NULL key in the array and no match: NULL (row dropped by a filter).
    """
    arr = _arr(labels)
    return arr.isNull() | ~F.array_contains(arr["key"], key)


def no_labels(labels="labels") -> Column:
    """`ARRAY_LENGTH(labels) = 0`; a NULL array is not selected."""
    return F.size(_arr(labels)) == 0
