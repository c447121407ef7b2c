"""DuckDB SQL for the correctness oracle.

The derived input tables of `costframe.fixtures` are repeated here as CTEs over the driver's raw
tables (lineitem, orders, part, nation, events), then each query is written in plain SQL. Only
the fixture constants are shared with the Spark side; every computation is re-stated.
"""

from __future__ import annotations

from costframe import constants as C
from costframe import fixtures as FX
from costframe.oracle_patterns import wording_rows


def _q(s: str | None) -> str:
    return "NULL" if s is None else "'" + s.replace("'", "''") + "'"


def _case(expr: str, values) -> str:
    whens = " ".join(f"WHEN {i} THEN {_q(v)}" for i, v in enumerate(values))
    return f"(CASE {expr} {whens} END)"


LA = C.BILLING_TZ


def la_date(ts: str) -> str:
    return f"CAST(timezone('{LA}', {ts} AT TIME ZONE 'UTC') AS DATE)"


KV_T = 'STRUCT("key" VARCHAR, "value" VARCHAR)'
CREDIT_T = 'STRUCT("type" VARCHAR, amount DECIMAL(18,6))'


def billing_cte() -> str:
    kv = lambda k, v, cond: f"CASE WHEN {cond} THEN {{'key': '{k}', 'value': {v}}} END"
    compute_labels = ", ".join([
        kv("instance_name", "'vm-' || CAST(l_partkey % 50 AS VARCHAR)", "h % 3 <> 0"),
        kv("psm", "'psm-' || CAST(l_partkey % 7 AS VARCHAR)", "h % 5 = 0"),
        kv("inner_ip", "'10.0.0.' || CAST(l_partkey % 5 AS VARCHAR)", "h % 7 = 0"),
        kv("forwarding-rule-name", "'fr-' || CAST(l_partkey % 11 AS VARCHAR)", "h % 9 = 0"),
        kv("instance_name", "'vm-again'", "h % 29 = 0"),
        "CASE WHEN h % 31 = 0 THEN {'key': CAST(NULL AS VARCHAR), 'value': 'no key'} END",
    ])
    storage_labels = kv("bucket_name", "'bkt-' || CAST(l_partkey % 13 AS VARCHAR)", "h % 4 <> 0")
    storage_labels += ", " + kv("bucket_name", "'bkt-again'", "h % 29 = 0")
    return f"""
bx AS (
  SELECT l.l_partkey, l.l_suppkey, l.l_quantity, l.l_discount, l.l_tax, o.o_custkey,
         l.l_orderkey * 7 + l.l_linenumber AS h,
         l.l_suppkey % 6 AS svc,
         TIMESTAMP '{FX.BASE_USAGE_TS}' + to_hours(CAST((l.l_orderkey * 7 + l.l_linenumber) % 2160 AS INTEGER)) AS ust,
         CAST(l.l_extendedprice AS DECIMAL(12,2)) AS price
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
),
billing_export AS (
  SELECT
    'BA-' || CAST(o_custkey % 4 AS VARCHAR) AS billing_account_id,
    {{'id': CASE WHEN svc < 3 THEN '{C.COMPUTE_SERVICE_ID}' WHEN svc IN (3, 4) THEN '{C.STORAGE_SERVICE_ID}'
           ELSE 'SVC-' || CAST(l_partkey % 4 AS VARCHAR) END}} AS service,
    {{'id': CASE WHEN svc < 5 THEN 'SKU-' || CAST(l_partkey AS VARCHAR) ELSE 'SKU-X' || CAST(l_partkey % 4 AS VARCHAR) END,
      'description': CASE WHEN svc < 3 THEN {_case('l_partkey % 10', FX.COMPUTE_DESCRIPTIONS)}
                          WHEN svc IN (3, 4) THEN {_case(f'l_partkey % {len(FX.STORAGE_DESCRIPTIONS)}', FX.STORAGE_DESCRIPTIONS)}
                          ELSE {_q(FX.OTHER_DESCRIPTION)} END}} AS sku,
    ust AS usage_start_time,
    {{'id': CASE WHEN o_custkey % 10 <> 9 THEN 'proj-' || CAST(o_custkey % 10 AS VARCHAR) END,
      'name': CASE WHEN o_custkey % 10 <> 9 THEN 'Project ' || CAST(o_custkey % 10 AS VARCHAR) END}} AS project,
    CASE WHEN svc < 3 THEN list_filter([{compute_labels}], lambda x: x IS NOT NULL)
         WHEN svc IN (3, 4) THEN list_filter([{storage_labels}], lambda x: x IS NOT NULL)
         WHEN h % 2 = 0 THEN NULL
         ELSE CAST([] AS {KV_T}[]) END AS labels,
    {{'location': {_case('l_suppkey % 5', FX.BILLING_LOCATIONS)}}} AS location,
    CASE WHEN svc IN (3, 4) THEN {{'name': CAST(NULL AS VARCHAR),
                                   'global_name': '//storage.googleapis.com/projects/_/buckets/bkt-' || CAST(l_partkey % 13 AS VARCHAR)}}
         WHEN svc < 3 AND h % 9 = 0 THEN {{'name': 'fr-' || CAST(l_partkey % 11 AS VARCHAR),
                                   'global_name': '//compute.googleapis.com/forwardingRules/fr-' || CAST(l_partkey % 11 AS VARCHAR)}}
         WHEN svc < 3 AND h % 3 <> 0 THEN {{'name': 'vm-' || CAST(l_partkey % 50 AS VARCHAR),
                                   'global_name': '//compute.googleapis.com/instances/vm-' || CAST(l_partkey % 50 AS VARCHAR)}}
    END AS resource,
    CASE WHEN h % 37 <> 0 THEN CAST(price AS DECIMAL(18,6)) END AS cost,
    {{'amount_in_pricing_units': CAST(l_quantity AS DECIMAL(18,6))}} AS usage,
    list_filter([
      CASE WHEN l_discount > 0 THEN {{'type': CASE WHEN h % 17 <> 0 THEN 'SUSTAINED_USAGE_DISCOUNT' END,
           'amount': CASE WHEN h % 19 <> 0 THEN CAST(-(price * CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(18,6)) END}} END,
      CASE WHEN l_tax > 0.05 THEN {{'type': 'PROMOTION',
           'amount': CAST(-(price * CAST(0.01 AS DECIMAL(3,2))) AS DECIMAL(18,6))}} END
    ], lambda x: x IS NOT NULL) AS credits,
    {{'month': strftime({la_date('ust')}, '%Y%m')}} AS invoice,
    CAST(CAST(ust AS DATE) + CAST(h % 3 AS INTEGER) AS DATE) AS partition_date
  FROM bx
)"""


def pricing_cte() -> str:
    slots = FX.price_description_rows()
    values = ",\n    ".join(f"({i}, {_q(h)}, {'TRUE' if u else 'FALSE'}, {_q(t)}, {'TRUE' if y else 'FALSE'})"
                           for i, h, u, t, y in slots)
    places = _case("p_partkey % 6", [pl for pl, _ in FX.PRICE_PLACES])
    reg_whens = " ".join(
        f"WHEN {i} THEN " + (("[" + ", ".join(_q(g) for g in regs) + "]") if regs else "CAST([] AS VARCHAR[])")
        for i, (_pl, regs) in enumerate(FX.PRICE_PLACES))
    cents = "CAST(round(p_retailprice * 100) AS BIGINT)"
    k = "CAST(n_nationkey + 10 + again * 7 AS BIGINT)"

    def money(scale: str) -> str:
        return f"CAST({cents} * {k} * CAST('{scale}' AS DECIMAL(8,7)) AS DECIMAL(18,6))"

    tier = lambda start, amt: f"{{'start_usage_amount': CAST({start} AS DECIMAL(18,6)), 'usd_amount': {amt}}}"
    return f"""
price_slots(slot, head, uses_place, tail, three_year) AS (VALUES
    {values}
),
pricing_export AS (
  SELECT
    {{'id': CASE WHEN p_partkey = 6 THEN '{C.CONFIDENTIAL_CPU_SKU}' WHEN p_partkey = 7 THEN '{C.CONFIDENTIAL_RAM_SKU}'
                ELSE 'SKU-' || CAST(p_partkey AS VARCHAR) END,
      'description': s.head || CASE WHEN s.uses_place THEN {places} ELSE '' END || s.tail
                     || CASE WHEN s.three_year AND (p_partkey // 8) % 2 = 0 THEN 's' ELSE '' END}} AS sku,
    {{'id': CASE p_partkey % 4 WHEN 0 THEN '{C.STORAGE_SERVICE_ID}' WHEN 1 THEN '{C.PRICE_LIST_EXTRA_SERVICE_ID}'
                ELSE '{C.COMPUTE_SERVICE_ID}' END}} AS service,
    {{'regions': CASE p_partkey % 6 {reg_whens} END}} AS geo_taxonomy,
    {{'tiered_rates': CASE WHEN p_partkey % 9 = 0 THEN NULL
                          ELSE [{tier(0, money('0.000002'))}, {tier(100, money('0.000001'))}] END}} AS list_price,
    {{'tiered_rates': CASE WHEN p_partkey % 11 = 0 THEN []
                          ELSE [{tier(0, money('0.000001'))}] END}} AS billing_account_price,
    CAST(DATE '{FX.BASE_PRICE_DATE}' + CAST(n_nationkey AS INTEGER) AS TIMESTAMP) + INTERVAL 1 HOUR * (6 + 5 * again) AS export_time,
    CAST(DATE '{FX.BASE_PRICE_DATE}' + CAST(n_nationkey AS INTEGER) AS DATE) AS partition_date
  FROM part CROSS JOIN nation
  JOIN (VALUES (0), (1)) t(again) ON again = 0 OR p_partkey % 5 = 0
  JOIN price_slots s ON s.slot = CAST((p_partkey // 4) % {len(slots)} AS INTEGER)
  WHERE n_nationkey < 3
)"""


def metric_cte() -> str:
    return f"""
metric_points AS (
  SELECT
    CASE WHEN event_type IN ('view', 'click') THEN '{C.NAT_RECEIVED_METRIC}'
         WHEN event_type = 'purchase' THEN '{C.NAT_SENT_METRIC}'
         WHEN event_type = 'signup' THEN '{C.OBJECT_COUNT_METRIC}'
         ELSE '{FX.OTHER_METRIC}' END AS metric,
    CASE WHEN event_type = 'signup' THEN '{C.GCS_BUCKET}' ELSE '{C.GCE_INSTANCE}' END AS resource_type,
    'proj-' || CAST(user_id % 3 AS VARCHAR) AS project_id,
    'nat-' || CAST(user_id % 8 AS VARCHAR) AS nat_gateway_name,
    {_case('user_id % 4', FX.METRIC_REGIONS)} AS region,
    'psm-' || CAST(user_id % 5 AS VARCHAR) AS psm,
    'vm-' || CAST(user_id AS VARCHAR) AS instance_name,
    '10.0.0.' || CAST(user_id % 32 AS VARCHAR) AS inner_ip,
    'bkt-' || CAST(user_id % 13 AS VARCHAR) AS bucket_name,
    {_case('user_id % 3', FX.STORAGE_CLASSES)} AS storage_class,
    ts,
    CAST(CASE WHEN event_type = 'signup' THEN round("value") ELSE round("value" * 1000000) END AS DOUBLE) AS "value"
  FROM events
)"""


def catalog_cte() -> str:
    rows = ", ".join(f"({_q(m)}, {_q(f)}, {c}, {r})" for m, f, c, r in FX.MACHINE_CATALOG_ROWS)
    return f"machine_catalog(machine_type, family, cpu, ram_gb) AS (VALUES {rows})"


def fleet_cte() -> str:
    return f"""
fleet_specs AS (
  SELECT CAST(p_partkey AS BIGINT) AS spec_id,
         {_case('p_partkey % 8', FX.FLEET_MACHINES)} AS machine_definition,
         CASE WHEN p_partkey % 3 = 0 THEN {_q(FX.FLEET_DISK)} END AS disk_definition,
         {_case('p_partkey % 5', FX.FLEET_REGIONS)} AS region
  FROM part JOIN (VALUES (0), (1)) t(again) ON again = 0 OR p_partkey % 7 = 0
)"""


def patterns_cte() -> str:
    rows = ",\n    ".join(f"({_q(k)}, {_q(c)}, {_q(a)}, {_q(b)})" for k, c, a, b in wording_rows())
    return f"sku_patterns(kind, component, like_first, like_last) AS (VALUES\n    {rows}\n)"


VIEWS = {
    "billing": billing_cte,
    "pricing": pricing_cte,
    "metrics": metric_cte,
    "catalog": catalog_cte,
    "fleet": fleet_cte,
    "patterns": patterns_cte,
}


def with_views(views: list[str], body: str) -> str:
    """`WITH <views>, <body>`: `body` continues the WITH list (more CTEs) and ends in a SELECT."""
    parts = [VIEWS[v]().strip() for v in views]
    return "WITH " + ",\n".join(parts) + ",\n" + body.strip()


# ---------------------------------------------------------------------------------------------
# SQL expression helpers (DuckDB dialect)
# ---------------------------------------------------------------------------------------------
def net_cost(cost: str = "cost", credits: str = "credits") -> str:
    return f"({cost} + COALESCE(list_sum(list_transform({credits}, lambda c: c.amount)), 0))"


def credit_sum(credits: str = "credits", exclude_promotions: bool = False) -> str:
    lst = credits if not exclude_promotions else f"list_filter({credits}, lambda c: c.\"type\" <> 'PROMOTION')"
    return f"COALESCE(list_sum(list_transform({lst}, lambda c: c.amount)), 0)"


def label(key: str, labels: str = "labels") -> str:
    return f"struct_extract(list_filter({labels}, lambda x: x.\"key\" = '{key}')[1], 'value')"


def has_label(key: str, labels: str = "labels") -> str:
    return f"list_contains(list_transform({labels}, lambda x: x.\"key\"), '{key}')"


def lacks_label(key: str, labels: str = "labels") -> str:
    """NOT IN: a NULL key without a match gives NULL."""
    keys = f"list_transform(COALESCE({labels}, CAST([] AS {KV_T}[])), lambda x: x.\"key\")"
    return (f"(CASE WHEN list_contains({keys}, '{key}') THEN FALSE "
            f"WHEN len(list_filter({keys}, lambda x: x IS NULL)) > 0 THEN NULL ELSE TRUE END)")


def compute_category(d: str = "sku.description") -> str:
    u = f"upper({d})"
    return f"""(CASE
 WHEN {u} LIKE '%CPU%' OR {u} LIKE '%CORE%' THEN 'CPU'
 WHEN {u} LIKE '%RAM%' THEN 'RAM'
 WHEN {u} LIKE '%GPU%' THEN 'GPU'
 WHEN {u} LIKE '%SSD%' AND {u} LIKE '%PD%' THEN 'PD_SSD'
 WHEN {u} LIKE '%SSD%' AND {u} LIKE '%LOCAL%' THEN 'LOCAL_SSD'
 WHEN {u} LIKE '%PD%' THEN 'PD_HDD'
 WHEN {u} LIKE '%NETWORK%' THEN 'NETWORK'
 ELSE 'OTHERS' END)"""


def sanitize(d: str = "sku.description") -> str:
    return f"trim(regexp_replace({d}, '\\W+', '_', 'g'), '_')"


def storage_category(d: str = "sku.description") -> str:
    u = f"upper({d})"
    s = sanitize(d)
    return f"""(CASE
 WHEN {u} LIKE 'STANDARD STORAGE%' THEN 'STORAGE'
 WHEN {u} LIKE 'NEARLINE STORAGE%' THEN 'STORAGE'
 WHEN {u} LIKE 'DOWNLOAD%' THEN {s}
 WHEN {u} LIKE '%STANDARD CLASS A OPERATIONS' THEN 'STANDARD_CLASS_A_OPERATIONS'
 WHEN {u} LIKE '%STANDARD CLASS B OPERATIONS' THEN 'STANDARD_CLASS_B_OPERATIONS'
 WHEN {u} LIKE '%EGRESS%' THEN {s}
 ELSE 'OTHERS' END)"""


def usage_date(ts: str = "usage_start_time") -> str:
    return la_date(ts)
