"""Fixed values that must equal the source application's for the same results.

Everything in the "fixed values" blocks below is data (identifiers, names, wording of price-list
descriptions), kept in natural order and together. Tables with rules (the SKU description patterns)
are generated from those values in `costframe.plans.skumap`.
"""

# ---------------------------------------------------------------------------------------------
# Service ids, time zone, billing rules
# ---------------------------------------------------------------------------------------------
COMPUTE_SERVICE_ID = "6F81-5844-456A"
STORAGE_SERVICE_ID = "95FF-2EF5-5EA1"
# Second service kept in the price list next to compute.
PRICE_LIST_EXTRA_SERVICE_ID = "65DF-8A98-0834"
PRICE_LIST_SERVICES = (COMPUTE_SERVICE_ID, PRICE_LIST_EXTRA_SERVICE_ID)

BILLING_TZ = "America/Los_Angeles"
REPORT_LAG_DAYS = 2
PARTITION_PAD_MONTHS = 1
PROMOTION_CREDIT_TYPE = "PROMOTION"

LABEL_INSTANCE_NAME = "instance_name"
LABEL_PSM = "psm"
LABEL_INNER_IP = "inner_ip"
LABEL_FORWARDING_RULE = "forwarding-rule-name"
LABEL_BUCKET_NAME = "bucket_name"

TEXT_DEFAULT = "--"
FORWARDING_RULE_PATH = "/forwardingRules/"

RESULT_ROW_CAP = 100     # rows returned by an ad-hoc question
DISPLAY_ROW_CAP = 50     # rows shown in an answer

# ---------------------------------------------------------------------------------------------
# Compute report categories (pivot column order)
# ---------------------------------------------------------------------------------------------
COMPUTE_CATEGORIES = ("CPU", "RAM", "NETWORK", "PD_SSD", "LOCAL_SSD", "PD_HDD", "GPU", "OTHERS")

# Substrings (upper-cased description) that send a line away from the unlabelled-residual report.
RESIDUAL_EXCLUDED_WORDS = ("CPU", "CORE", "RAM", "GPU", "PD", "NETWORK")

# ---------------------------------------------------------------------------------------------
# Storage report pivot columns (network) and the named categories
# ---------------------------------------------------------------------------------------------
STORAGE_NETWORK_COLUMNS = (
    "Download_APAC",
    "Download_Australia",
    "Download_China",
    "Download_Worldwide_Destinations_excluding_Asia_Australia",
    "APAC_based_Storage_egress_via_peered_interconnect_network",
    "EU_based_Storage_egress_via_peered_interconnect_network",
    "GCP_Storage_egress_between_APAC_and_SA",
    "GCP_Storage_egress_between_AU_and_APAC",
    "GCP_Storage_egress_between_AU_and_EU",
    "GCP_Storage_egress_between_AU_and_NA",
    "GCP_Storage_egress_between_AU_and_SA",
    "GCP_Storage_egress_between_EU_and_APAC",
    "GCP_Storage_egress_between_EU_and_SA",
    "GCP_Storage_egress_between_NA_and_APAC",
    "GCP_Storage_egress_between_NA_and_EU",
    "GCP_Storage_egress_between_NA_and_SA",
    "Inter_region_GCP_Storage_egress_within_APAC",
    "Inter_region_GCP_Storage_egress_within_AU",
    "Inter_region_GCP_Storage_egress_within_EU",
    "Inter_region_GCP_Storage_egress_within_NA",
    "Inter_region_GCP_Storage_egress_within_SA",
    "NA_based_Storage_egress_via_peered_interconnect_network",
    "Networking_Traffic_Egress_GAE_Firebase_Storage",
)
STORAGE_CAT = "STORAGE"
CLASS_A_CAT = "STANDARD_CLASS_A_OPERATIONS"
CLASS_B_CAT = "STANDARD_CLASS_B_OPERATIONS"
OTHERS_CAT = "OTHERS"

# ---------------------------------------------------------------------------------------------
# Price estimates
# ---------------------------------------------------------------------------------------------
HOURS_PER_MONTH = 730
CALCULATION_PERIOD = "monthly (based on 730 hours)"
CONFIDENTIAL_CPU_SKU = "E5BD-12DD-EB30"
CONFIDENTIAL_RAM_SKU = "3999-11C3-1EE4"
DEFAULT_BOOT_DISK = "pd-standard"
LOCAL_SSD = "local-ssd"
# Machine-name suffixes dropped before the catalogue lookup (regular expressions).
MACHINE_SUFFIX_PATTERNS = ("-nps4", "-[0-9]+lssd", "-ssd[0-9]+t")

# Region repairs in the SKU map.
DELHI_REGION = "asia-south2"
WARSAW_REGION = "europe-central2"

# ---------------------------------------------------------------------------------------------
# Metric types and resource types
# ---------------------------------------------------------------------------------------------
NAT_RECEIVED_METRIC = "compute.googleapis.com/nat/received_bytes_count"
NAT_SENT_METRIC = "compute.googleapis.com/nat/sent_bytes_count"
OBJECT_COUNT_METRIC = "storage.googleapis.com/storage/object_count"
GCE_INSTANCE = "gce_instance"
GCS_BUCKET = "gcs_bucket"
BYTES_PER_GIB = 2 ** 30
NAT_SERIES_LABELS = ("project_id", "nat_gateway_name", "region", "psm", "instance_name", "inner_ip")
OBJECT_COUNT_GROUP = ("project_id", "bucket_name", "region", "storage_class")
