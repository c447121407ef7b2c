"""SKU map (component, region) -> SKU id, built from the newest price snapshot.

One join of the compute price rows with a small pattern table, by the patterns' literal beginnings
(`operators.prefix_join`), replaces one warehouse query per component. The pattern table is generated from the fixed wording below;
users can pass their own table with the same schema (`kind, component, like_first, like_last`).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from costframe.constants import COMPUTE_SERVICE_ID, DELHI_REGION, WARSAW_REGION
from costframe.operators.local import local_table
from costframe.operators.prefix_join import like_join
from costframe.schema import SKU_PATTERNS
from costframe.sources.pricing import latest_snapshot

# ---------------------------------------------------------------------------------------------
# Price-list wording of machine families (CPU and RAM SKUs).
# {res} is "Core" or "Ram" (on-demand wording), {unit} is "Cpu" or "Ram" (commitment wording).
# Columns: family, predefined, custom (None = no custom SKUs), commitment, 3-year suffix.
# ---------------------------------------------------------------------------------------------
FAMILY_WORDING = (
    ("e2", "E2 Instance {res} running in%", "E2 Instance {res} running in%",
     "Commitment v1: E2 {unit} in%", "%for 3 Year"),
    ("a2", "A2 Instance {res} running in%", None, "Commitment v1: A2 {unit} in%", "%for 3 Year"),
    ("a3", "A3 Instance {res} running in%", None, "Commitment v1: A3 {unit} in%", "%for 3 Years"),
    ("g2", "G2 Instance {res} running in%", "G2 Custom Instance {res} running in%",
     "Commitment v1: G2 {unit} in%", "%for 3 Years"),
    ("n1", "N1 Predefined Instance {res} running in%", "Custom Instance {res} running in%",
     "Commitment v1: {unit} in%", "%for 3 Year"),
    ("n2", "N2 Instance {res} running in%", "N2 Custom Instance {res} running in%",
     "Commitment v1: N2 {unit} in%", "%for 3 Year"),
    ("n2d", "N2D AMD Instance {res} running in%", "N2D AMD Custom Instance {res} running in%",
     "Commitment v1: N2D AMD {unit} in%", "%for 3 Year"),
    ("c2", "Compute optimized {res} running in%", None,
     "Commitment: Compute optimized {res} running in%", "%for 3 Year"),
    ("c3", "C3 Instance {res} running in%", None, "Commitment v1: C3 {unit} in%", "%for 3 Years"),
    ("c3d", "C3D Instance {res} running in%", None, "Commitment v1: C3D {unit} in%", "%for 3 Years"),
    ("g4", "G4 Instance {res} running in%", None, "Commitment v1: G4 {unit} in%", "%for 3 Years"),
    ("c4", "C4 Instance {res} running in%", None, "Commitment v1: C4 {unit} in%", "%for 3 Years"),
    ("c4d", "C4D Instance {res} running in%", None, "Commitment v1: C4D {unit} in%", "%for 3 Years"),
    ("z3", "Z3 Instance {res} running in%", None, "Commitment v1: Z3 {unit} in%", "%for 3 Years"),
)

# ---------------------------------------------------------------------------------------------
# GPU wording. Columns: GPU type, on-demand, commitment, 3-year suffix.
# ---------------------------------------------------------------------------------------------
GPU_WORDING = (
    ("nvidia-tesla-a100", "Nvidia Tesla A100 GPU running in%",
     "Commitment v1: Nvidia Tesla A100 GPU running in%", "%for 3 Year"),
    ("nvidia-tesla-t4", "Nvidia Tesla T4 GPU running in%",
     "Commitment v1: Nvidia Tesla T4 GPU running in%", "%for 3 Year"),
    ("nvidia-l4", "Nvidia L4 GPU running in%", "Commitment v1: Nvidia L4 GPU running in%", "%for 3 Years"),
    ("nvidia-h100-80gb", "Nvidia H100 80GB GPU running in%",
     "Commitment v1: Nvidia H100 80GB GPU running in%", "%for 3 Years"),
    ("nvidia-h100-mega-80gb", "Reserved Nvidia H100 80GB Mega GPU in%",
     "Commitment v1: Nvidia H100 80GB Mega GPU running in%", "%for 3 Years"),
    ("nvidia-rtx-pro-6000", "RTX 6000 96GB running in%", "Commitment v1: RTX 6000 96GB running in%",
     "%for 3 Years"),
    ("nvidia-b200", "A4 Nvidia B200 (1 gpu slice) running in%",
     "Commitment v1: A4 Nvidia B200 (1 gpu slice) in%", "%for 3 Year%"),
)
ONE_YEAR_SUFFIX = "%for 1 Year"

# ---------------------------------------------------------------------------------------------
# Disk and NAT wording. Columns: component, (alternative first patterns), last pattern.
# ---------------------------------------------------------------------------------------------
DISK_WORDING = (
    ("local-ssd", ("SSD backed Local Storage", "SSD backed Local Storage in%"), None),
    ("local-ssd-cud-1y", ("Commitment v1: Local SSD in%",), "%for 1 Year"),
    ("local-ssd-cud-3y", ("Commitment v1: Local SSD in%",), "%for 3 Year"),
    ("pd-ssd", ("SSD backed PD Capacity", "SSD backed PD Capacity in%"), None),
    ("pd-balanced", ("Balanced PD Capacity", "Balanced PD Capacity in%"), None),
    ("pd-standard", ("Storage PD Capacity", "Storage PD Capacity in%"), None),
    ("pd-custom", ("Efficient Storage PD Capacity in%",), None),
)
NAT_WORDING = (("nat-data", ("NAT Gateway: Data processing charge in%",), None),)


def pattern_rows(match_plural: bool = False) -> list[tuple[str, str, str, str | None]]:
    """(kind, component, like_first, like_last) rows of the default pattern table.

    `match_plural=True` lets every 3-year pattern also match descriptions ending in "Years".
    """
    def three(s: str) -> str:
        return "%for 3 Year%" if match_plural else s

    rows: list[tuple[str, str, str, str | None]] = []
    for kind, res, unit in (("cpu", "Core", "Cpu"), ("ram", "Ram", "Ram")):
        for fam, pre, cus, cud, y3 in FAMILY_WORDING:
            rows.append((kind, f"{fam}-predefined", pre.format(res=res), None))
            if cus is not None:
                rows.append((kind, f"{fam}-custom", cus.format(res=res), None))
            first = cud.format(res=res, unit=unit)
            rows.append((kind, f"{fam}-cud-1y", first, ONE_YEAR_SUFFIX))
            rows.append((kind, f"{fam}-cud-3y", first, three(y3)))
    for gpu, od, cud, y3 in GPU_WORDING:
        rows.append(("gpu", gpu, od, None))
        rows.append(("gpu", f"{gpu}-cud-1y", cud, ONE_YEAR_SUFFIX))
        rows.append(("gpu", f"{gpu}-cud-3y", cud, three(y3)))
    for kind, table in (("disk", DISK_WORDING), ("nat", NAT_WORDING)):
        for comp, firsts, last in table:
            for first in firsts:
                rows.append((kind, comp, first, three(last) if last and "3 Year" in last else last))
    return rows


def pattern_table(spark: SparkSession, match_plural: bool = False) -> DataFrame:
    return local_table(spark, pattern_rows(match_plural), SKU_PATTERNS)


def sku_region_map(pricing: DataFrame, patterns: DataFrame) -> DataFrame:
    """(kind, component, region, sku_id) from the newest snapshot of the compute price list.

    * description LIKE like_first AND (like_last IS NULL OR description LIKE like_last), case-sensitive;
    * a description with "delhi" (any case) and no regions gets asia-south2;
    * a description with "Warsaw" (case-sensitive) maps to europe-central2 only;
    * several SKUs for one (kind, component, region): the largest sku_id wins (deterministic).
    """
    snap = latest_snapshot(pricing).filter(F.col("service.id") == COMPUTE_SERVICE_ID)
    rows = snap.select(
        F.col("sku.id").alias("sku_id"),
        F.col("sku.description").alias("description"),
        F.col("geo_taxonomy.regions").alias("regions"),
    )
    rows = rows.withColumn(
        "regions",
        F.when(F.lower("description").contains("delhi") & (F.size("regions") == 0),
               F.array(F.lit(DELHI_REGION))).otherwise(F.col("regions")))
    rows = rows.withColumn(
        "regions",
        F.when(F.col("description").contains("Warsaw"), F.array(F.lit(WARSAW_REGION)))
        .otherwise(F.col("regions")))
    matched = like_join(rows, "description", patterns, "like_first", "like_last", name="sku-patterns")
    exploded = matched.select("kind", "component", F.explode("regions").alias("region"), "sku_id")
    return exploded.groupBy("kind", "component", "region").agg(F.max("sku_id").alias("sku_id"))
