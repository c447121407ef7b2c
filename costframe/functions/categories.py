"""SKU description categories for the compute and storage reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from costframe.constants import (CLASS_A_CAT, CLASS_B_CAT, OTHERS_CAT, RESIDUAL_EXCLUDED_WORDS,
                                 STORAGE_CAT)


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sanitize_name(desc="sku.description") -> Column:
    """Runs of non-word characters become `_`, then leading/trailing `_` are trimmed."""
    return F.regexp_replace(F.regexp_replace(_c(desc), r"\W+", "_"), r"^_+|_+$", "")


def compute_category(desc="sku.description") -> Column:
    """First match wins; a NULL description falls through to OTHERS."""
    u = F.upper(_c(desc))
    has = u.contains
    return (F.when(has("CPU") | has("CORE"), "CPU")
            .when(has("RAM"), "RAM")
            .when(has("GPU"), "GPU")
            .when(has("SSD") & has("PD"), "PD_SSD")
            .when(has("SSD") & has("LOCAL"), "LOCAL_SSD")
            .when(has("PD"), "PD_HDD")
            .when(has("NETWORK"), "NETWORK")
            .otherwise("OTHERS"))


def is_residual_compute(desc="sku.description") -> Column:
    """Lines that belong to no named compute category: none of the category words, and not
    SSD+LOCAL. A NULL description gives NULL (dropped)."""
    u = F.upper(_c(desc))
    cond = ~(u.contains("SSD") & u.contains("LOCAL"))
    for w in RESIDUAL_EXCLUDED_WORDS:
        cond = cond & ~u.contains(w)
    return cond


def storage_category(desc="sku.description") -> Column:
    """Storage line category: STORAGE, class A/B operations, sanitised download/egress names,
    OTHERS. Prefix/suffix tests are on the upper-cased description."""
    u = F.upper(_c(desc))
    clean = sanitize_name(desc)
    return (F.when(u.startswith("STANDARD STORAGE") | u.startswith("NEARLINE STORAGE"), STORAGE_CAT)
            .when(u.startswith("DOWNLOAD"), clean)
            .when(u.endswith("STANDARD CLASS A OPERATIONS"), CLASS_A_CAT)
            .when(u.endswith("STANDARD CLASS B OPERATIONS"), CLASS_B_CAT)
            .when(u.contains("EGRESS"), clean)
            .otherwise(OTHERS_CAT))
