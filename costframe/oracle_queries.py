"""DuckDB oracle SQL per registered query (same column names as the Spark results)."""

from __future__ import annotations

import calendar
import datetime as _dt

from costframe import constants as C
from costframe import oracle as O
from costframe.registry import (BUCKET_FRAGMENT, COMPARISON_REGION, FEB_RANGE, FULL_RANGE, LB_NAME,
                                MONTH, MONTHS, NAT_DAYS, REPORT_DAY)

SQL: dict[str, str] = {}

CATS = C.COMPUTE_CATEGORIES


def _r1(day_filter: str) -> str:
    pivots = ",\n    ".join(f"SUM(CASE WHEN sku_category = '{c}' THEN total_cost END) AS {c}" for c in CATS)
    outs = ",\n  ".join(f"CAST(COALESCE({c}, 0) AS DOUBLE) AS {c}" for c in CATS)
    subtotal = " + ".join(f"COALESCE({c}, 0)" for c in CATS)
    return O.with_views(["billing"], f"""
r1_lines AS (
  SELECT billing_account_id AS billing_name, invoice.month AS invoice_month,
         {O.usage_date()} AS usage_date, project.id AS project_id,
         {O.net_cost()} AS total_cost,
         {O.label('instance_name')} AS instance_name,
         {O.label('psm')} AS psm,
         {O.label('inner_ip')} AS inner_ip,
         {O.compute_category()} AS sku_category
  FROM billing_export
  WHERE service.id = '{C.COMPUTE_SERVICE_ID}' {day_filter}
    AND {O.lacks_label('forwarding-rule-name')}
),
r1_pivot AS (
  SELECT billing_name, invoice_month, usage_date, project_id, instance_name, psm, inner_ip,
    {pivots}
  FROM r1_lines
  GROUP BY billing_name, invoice_month, usage_date, project_id, instance_name, psm, inner_ip
)
SELECT billing_name, invoice_month, usage_date, project_id,
  COALESCE(instance_name, '--') AS instance_name, COALESCE(psm, '--') AS psm, inner_ip,
  CAST({subtotal} AS DOUBLE) AS SUBTOTAL,
  {outs}
FROM r1_pivot""")


SQL["compute_instance_cost"] = _r1("")
SQL["compute_instance_cost_day"] = _r1(f"AND {O.usage_date()} = DATE '{REPORT_DAY}'")

SQL["load_balancer_cost"] = O.with_views(["billing"], f"""
r2_lines AS (
  SELECT billing_account_id AS billing_name, invoice.month AS invoice_month,
         {O.usage_date()} AS usage_date, project.id AS project_id,
         {O.net_cost()} AS total_cost,
         {O.label('forwarding-rule-name')} AS forwarding_rule_name
  FROM billing_export
  WHERE service.id = '{C.COMPUTE_SERVICE_ID}' AND {O.has_label('forwarding-rule-name')}
)
SELECT billing_name, invoice_month, usage_date, project_id,
       COALESCE(forwarding_rule_name, '--') AS forwarding_rule_name,
       CAST(SUM(total_cost) AS DOUBLE) AS SUBTOTAL_USD
FROM r2_lines
GROUP BY billing_name, invoice_month, usage_date, project_id, r2_lines.forwarding_rule_name""")

_u = "upper(sku.description)"
SQL["other_compute_cost"] = O.with_views(["billing"], f"""
r3_lines AS (
  SELECT billing_account_id AS billing_name, invoice.month AS invoice_month,
         {O.usage_date()} AS usage_date, project.name AS project_name,
         {O.net_cost()} AS total_cost, sku.description AS description
  FROM billing_export
  WHERE service.id = '{C.COMPUTE_SERVICE_ID}'
    AND {_u} NOT LIKE '%CPU%' AND {_u} NOT LIKE '%CORE%' AND {_u} NOT LIKE '%RAM%'
    AND {_u} NOT LIKE '%GPU%' AND {_u} NOT LIKE '%PD%' AND {_u} NOT LIKE '%NETWORK%'
    AND NOT ({_u} LIKE '%SSD%' AND {_u} LIKE '%LOCAL%')
    AND len(labels) = 0
)
SELECT description, billing_name, project_name, invoice_month, usage_date,
       CAST(SUM(total_cost) AS DOUBLE) AS SUBTOTAL
FROM r3_lines
GROUP BY description, billing_name, project_name, invoice_month, usage_date""")


def _r4(by_account: bool, same: str = "=", unlisted: bool = False) -> str:
    net = list(C.STORAGE_NETWORK_COLUMNS)
    keys = ["bucket_name", "region", "project_name", "usage_date", "invoice_month"] + (
        ["billing_name"] if by_account else [])

    def on(a, b):
        return " AND ".join(f"{a}.{k} {same} {b}.{k}" for k in keys)

    pcols = net + ["OTHERS"]
    pivots = ",\n    ".join(f"SUM(CASE WHEN sku_category = '{c}' THEN total_cost END) AS {c}" for c in pcols)
    if unlisted:
        known = ", ".join(f"'{c}'" for c in pcols)
        pivots += f",\n    SUM(CASE WHEN sku_category NOT IN ({known}) THEN total_cost END) AS NETWORK_UNLISTED"
        net.append("NETWORK_UNLISTED")
    net_sum = " + ".join(f"COALESCE({c}, 0)" for c in net)
    net_out = ",\n  ".join(f"CAST(COALESCE(N.{c}, 0) AS DOUBLE) AS {c}" for c in net)
    kl = ", ".join(keys)
    return O.with_views(["billing"], f"""
bwc AS (
  SELECT billing_account_id AS billing_name, invoice.month AS invoice_month,
         {O.usage_date()} AS usage_date, project.name AS project_name,
         location.location AS region, {O.net_cost()} AS total_cost,
         usage.amount_in_pricing_units * CAST(day(last_day({O.usage_date()})) AS INTEGER) AS total_usage,
         COALESCE({O.label('bucket_name')}, '--') AS bucket_name,
         {O.sanitize()} AS sku_description,
         {O.storage_category()} AS sku_category
  FROM billing_export WHERE service.id = '{C.STORAGE_SERVICE_ID}'
),
bucket_info AS (
  SELECT billing_name, invoice_month, usage_date, project_name, region, bucket_name
  FROM bwc GROUP BY billing_name, invoice_month, usage_date, project_name, region, bucket_name
),
storage_cost AS (
  SELECT billing_name, invoice_month, project_name, region, bucket_name, usage_date,
         sku_description AS STORAGE_TYPE, SUM(total_cost) AS STORAGE, SUM(total_usage) AS STORAGE_USAGE
  FROM bwc WHERE sku_category = 'STORAGE'
  GROUP BY billing_name, invoice_month, project_name, region, sku_description, bucket_name, usage_date
),
class_a AS (
  SELECT billing_name, invoice_month, project_name, region, bucket_name, usage_date,
         sku_description AS A_TYPE, SUM(total_cost) AS A_COST
  FROM bwc WHERE sku_category = 'STANDARD_CLASS_A_OPERATIONS'
  GROUP BY billing_name, invoice_month, project_name, region, sku_description, bucket_name, usage_date
),
class_b AS (
  SELECT billing_name, invoice_month, project_name, region, bucket_name, usage_date,
         sku_description AS B_TYPE, SUM(total_cost) AS B_COST
  FROM bwc WHERE sku_category = 'STANDARD_CLASS_B_OPERATIONS'
  GROUP BY billing_name, invoice_month, project_name, region, sku_description, bucket_name, usage_date
),
net_pivot AS (
  SELECT {kl},
    {pivots}
  FROM bwc WHERE sku_category NOT IN ('STORAGE', 'STANDARD_CLASS_A_OPERATIONS', 'STANDARD_CLASS_B_OPERATIONS')
  GROUP BY {kl}
),
network AS (
  SELECT *, {net_sum} AS NETWORK_PRICE FROM net_pivot
)
SELECT B.billing_name, B.invoice_month, B.usage_date, B.project_name, B.region, B.bucket_name,
  CAST(COALESCE(S.STORAGE, 0) + COALESCE(A.A_COST, 0) + COALESCE(BB.B_COST, 0)
       + COALESCE(N.NETWORK_PRICE, 0) + COALESCE(N.OTHERS, 0) AS DOUBLE) AS SUBTOTAL,
  COALESCE(S.STORAGE_TYPE, '--') AS STORAGE_TYPE,
  CAST(COALESCE(S.STORAGE, 0) AS DOUBLE) AS STORAGE,
  CAST(COALESCE(S.STORAGE_USAGE, 0) AS DOUBLE) AS USAGE_GB,
  COALESCE(A.A_TYPE, '--') AS STANDARD_CLASS_A_OPERATIONS_TYPE,
  CAST(COALESCE(A.A_COST, 0) AS DOUBLE) AS STANDARD_CLASS_A_OPERATIONS,
  COALESCE(BB.B_TYPE, '--') AS STANDARD_CLASS_B_OPERATIONS_TYPE,
  CAST(COALESCE(BB.B_COST, 0) AS DOUBLE) AS STANDARD_CLASS_B_OPERATIONS,
  {net_out},
  CAST(COALESCE(N.NETWORK_PRICE, 0) AS DOUBLE) AS NETWORK_PRICE,
  CAST(COALESCE(N.OTHERS, 0) AS DOUBLE) AS OTHERS
FROM bucket_info B
LEFT JOIN storage_cost S ON {on('B', 'S')}
LEFT JOIN class_a A ON {on('B', 'A')}
LEFT JOIN class_b BB ON {on('B', 'BB')}
LEFT JOIN network N ON {on('B', 'N')}""")


SQL["storage_bucket_cost"] = _r4(False)
SQL["storage_bucket_cost_by_account"] = _r4(True)
SQL["storage_bucket_cost_unlisted"] = _r4(False, unlisted=True)
SQL["storage_bucket_cost_display"] = SQL["storage_bucket_cost"]
SQL["storage_bucket_cost_null_safe"] = _r4(False, "IS NOT DISTINCT FROM")


# ---------------------------------------------------------------------------------------------
# Spend questions and line-level operators
# ---------------------------------------------------------------------------------------------


def _add_months(d: str, n: int) -> str:
    x = _dt.date.fromisoformat(d)
    m = x.month - 1 + n
    y, m = x.year + m // 12, m % 12 + 1
    return _dt.date(y, m, min(x.day, calendar.monthrange(y, m)[1])).isoformat()


def _month_first_last(m: str) -> tuple[str, str]:
    y, mm = int(m[:4]), int(m[4:])
    return _dt.date(y, mm, 1).isoformat(), _dt.date(y, mm, calendar.monthrange(y, mm)[1]).isoformat()


def _accounts(lo: str, hi: str) -> str:
    """The four account tables, each pruned by the padded partition range."""
    branches = "\n  UNION ALL\n  ".join(
        f"SELECT * FROM billing_export WHERE billing_account_id = 'BA-{i}' "
        f"AND partition_date BETWEEN DATE '{_add_months(lo, -1)}' AND DATE '{_add_months(hi, 1)}'"
        for i in range(4))
    return f"acct AS (\n  {branches}\n)"


def _usage_between(a: str, b: str) -> str:
    return f"{O.usage_date()} BETWEEN DATE '{a}' AND DATE '{b}'"


_MODES = {
    "raw": "SUM(cost)",
    "credits_no_promotions": f"SUM(cost) + SUM({O.credit_sum(exclude_promotions=True)})",
    "all_credits": f"SUM(cost) + SUM({O.credit_sum()})",
}


def _summary(keys: str, src: str, where: str = "TRUE") -> str:
    return (f"SELECT {keys}, COUNT(*) AS n_lines, CAST(SUM(cost) AS DOUBLE) AS cost, "
            f"CAST(SUM({O.net_cost()}) AS DOUBLE) AS net_cost FROM {src} WHERE {where} GROUP BY ALL")


SQL["account_union"] = O.with_views(["billing"], f"""
u AS (
  {' UNION ALL '.join(f"SELECT * FROM billing_export WHERE billing_account_id = 'BA-{i}'" for i in range(4))}
)
{_summary('billing_account_id', 'u')}""")

SQL["partition_padded_scan"] = O.with_views(["billing"], f"""
{_accounts(*FEB_RANGE)}
{_summary(f'{O.usage_date()} AS usage_date', 'acct', _usage_between(*FEB_RANGE))}""")


def _by_mode(keys: str, src_where: str, out_keys: str = "") -> str:
    sel = ", ".join(f"{v} AS {k}" for k, v in _MODES.items())
    case = " ".join(f"WHEN '{k}' THEN {k}" for k in _MODES)
    modes = ", ".join(f"('{k}')" for k in _MODES)
    kk = (keys + ", ") if keys else ""
    ok = (out_keys + ", ") if out_keys else ""
    gb = "GROUP BY ALL" if keys else ""
    return f"""
agg AS (SELECT {kk}{sel} FROM acct WHERE {src_where} {gb})
SELECT {ok}m.cost_mode, CAST(CASE m.cost_mode {case} END AS DOUBLE) AS cost
FROM agg CROSS JOIN (VALUES {modes}) m(cost_mode)"""


_m_first, _m_last = _month_first_last(MONTH)
SQL["spend_total_month"] = O.with_views(["billing"], _accounts(_m_first, _m_last) + ",\n" + _by_mode(
    "", f"invoice.month = '{MONTH}'"))
_ms_first, _ms_last = _month_first_last(MONTHS[0])[0], _month_first_last(MONTHS[1])[1]
SQL["spend_by_cost_mode"] = O.with_views(["billing"], _accounts(_ms_first, _ms_last) + ",\n" + _by_mode(
    "invoice.month AS invoice_month", f"invoice.month BETWEEN '{MONTHS[0]}' AND '{MONTHS[1]}'", "invoice_month"))

SQL["top_services"] = O.with_views(["billing"], f"""
{_accounts(*FULL_RANGE)}
SELECT service.id AS service_id, CAST({_MODES['all_credits']} AS DOUBLE) AS cost
FROM acct WHERE {_usage_between(*FULL_RANGE)}
GROUP BY service.id ORDER BY cost DESC NULLS LAST, service_id ASC NULLS LAST LIMIT 5""")

SQL["top_projects_for_service"] = O.with_views(["billing"], f"""
{_accounts(*FULL_RANGE)}
SELECT project.id AS project_id, CAST({_MODES['credits_no_promotions']} AS DOUBLE) AS cost
FROM acct WHERE {_usage_between(*FULL_RANGE)} AND service.id = '{C.COMPUTE_SERVICE_ID}'
GROUP BY project.id ORDER BY cost DESC NULLS LAST, project_id ASC NULLS LAST LIMIT 5""")

SQL["bucket_cost"] = O.with_views(["billing"], f"""
{_accounts(*FULL_RANGE)}
SELECT resource.global_name AS bucket_global_name, CAST({_MODES['raw']} AS DOUBLE) AS cost
FROM acct WHERE {_usage_between(*FULL_RANGE)} AND contains(resource.global_name, '{BUCKET_FRAGMENT}')
GROUP BY resource.global_name""")

SQL["lb_cost_by_name"] = O.with_views(["billing"], f"""
{_accounts(*FULL_RANGE)}
SELECT resource.name AS forwarding_rule, invoice.month AS invoice_month,
       CAST({_MODES['all_credits']} AS DOUBLE) AS cost
FROM acct WHERE {_usage_between(*FULL_RANGE)} AND resource.name = '{LB_NAME}'
  AND resource.global_name LIKE '%/forwardingRules/%'
GROUP BY resource.name, invoice.month""")

SQL["net_cost_lines"] = O.with_views(["billing"], f"""
x AS (SELECT 1)
SELECT billing_account_id, service.id AS service_id, sku.id AS sku_id, usage_start_time,
       CAST(cost AS DOUBLE) AS cost, CAST({O.net_cost()} AS DOUBLE) AS net_cost
FROM billing_export""")

SQL["label_presence"] = O.with_views(["billing"], f"""
x AS (SELECT 1)
{_summary(f'{O.usage_date()} AS usage_date', 'billing_export', O.has_label('forwarding-rule-name'))}""")

SQL["label_absence"] = O.with_views(["billing"], f"""
x AS (SELECT 1)
{_summary('service.id AS service_id', 'billing_export', O.lacks_label('forwarding-rule-name'))}""")

SQL["unlabelled_lines"] = O.with_views(["billing"], f"""
x AS (SELECT 1)
{_summary('service.id AS service_id', 'billing_export', 'len(labels) = 0')}""")

SQL["compute_category_counts"] = O.with_views(["billing"], f"""
x AS (SELECT 1)
{_summary(f'{O.compute_category()} AS sku_category', 'billing_export', f"service.id = '{C.COMPUTE_SERVICE_ID}'")}""")

SQL["storage_category_counts"] = O.with_views(["billing"], f"""
x AS (SELECT 1)
{_summary(f'{O.storage_category()} AS sku_category', 'billing_export', f"service.id = '{C.STORAGE_SERVICE_ID}'")}""")

SQL["usage_month_scaled"] = O.with_views(["billing"], f"""
x AS (SELECT 1)
SELECT {O.usage_date()} AS usage_date,
       CAST(SUM(usage.amount_in_pricing_units * CAST(day(last_day({O.usage_date()})) AS INTEGER)) AS DOUBLE) AS total_usage
FROM billing_export WHERE service.id = '{C.STORAGE_SERVICE_ID}' GROUP BY ALL""")


# ---------------------------------------------------------------------------------------------
# Price catalogue, SKU map, disk prices, fleet estimates
# ---------------------------------------------------------------------------------------------

_NEWEST = "partition_date = (SELECT max(partition_date) FROM pricing_export)"
_SERVICES = ", ".join(f"'{s}'" for s in C.PRICE_LIST_SERVICES)


def _first(book: str) -> str:
    return f"CASE WHEN len({book}.tiered_rates) > 0 THEN {book}.tiered_rates[1].usd_amount END"


_ONE = "QUALIFY row_number() OVER (PARTITION BY sku.id ORDER BY export_time DESC) = 1"
_LP = f"lp AS (SELECT * FROM pricing_export WHERE {_NEWEST} AND service.id IN ({_SERVICES}) {_ONE})"
_PP = f"""pp AS (
  SELECT * FROM (SELECT sku.id AS sku_id, {_first('list_price')} AS list_price,
                        {_first('billing_account_price')} AS account_price FROM lp)
  WHERE list_price IS NOT NULL OR account_price IS NOT NULL
)"""
_SMAP = f"""snap_c AS (SELECT * FROM pricing_export WHERE {_NEWEST} AND service.id = '{C.COMPUTE_SERVICE_ID}'),
sku_rows AS (
  SELECT sku.id AS sku_id, sku.description AS description,
    CASE WHEN contains(sku.description, 'Warsaw') THEN ['{C.WARSAW_REGION}']
         WHEN lower(sku.description) LIKE '%delhi%' AND len(geo_taxonomy.regions) = 0 THEN ['{C.DELHI_REGION}']
         ELSE geo_taxonomy.regions END AS regions
  FROM snap_c
),
sku_match AS (
  SELECT p.kind, p.component, r.sku_id, UNNEST(r.regions) AS region
  FROM sku_rows r JOIN sku_patterns p
    ON r.description LIKE p.like_first AND (p.like_last IS NULL OR r.description LIKE p.like_last)
),
smap AS (SELECT kind, component, region, max(sku_id) AS sku_id FROM sku_match GROUP BY kind, component, region)"""

SQL["latest_prices"] = O.with_views(["pricing"], f"""
{_LP}
SELECT sku.id AS sku_id, sku.description AS sku_description,
  CAST(len(COALESCE(list_price.tiered_rates, [])) AS BIGINT) AS n_list_tiers,
  CAST(len(COALESCE(billing_account_price.tiered_rates, [])) AS BIGINT) AS n_account_tiers,
  CAST({_first('list_price')} AS DOUBLE) AS list_price,
  CAST({_first('billing_account_price')} AS DOUBLE) AS account_price,
  CAST(export_time AS DATE) AS pricing_date
FROM lp""")

SQL["first_tier_prices"] = O.with_views(["pricing"], f"""
{_LP},
{_PP}
SELECT sku_id, CAST(list_price AS DOUBLE) AS list_price, CAST(account_price AS DOUBLE) AS account_price FROM pp""")

SQL["sku_price_lookup"] = O.with_views(["billing", "pricing"], f"""
req AS (SELECT DISTINCT sku.id AS sku_id FROM billing_export),
found AS (
  SELECT sku.id AS sku_id, sku.description AS sku_description,
         {_first('list_price')} AS list_price, {_first('billing_account_price')} AS account_price,
         CAST(len(COALESCE(list_price.tiered_rates, [])) AS BIGINT) AS n_list_tiers,
         CAST(export_time AS DATE) AS pricing_date
  FROM pricing_export WHERE {_NEWEST} {_ONE}
)
SELECT r.sku_id, f.sku_description, CAST(f.list_price AS DOUBLE) AS list_price,
       CAST(f.account_price AS DOUBLE) AS account_price, f.n_list_tiers, f.pricing_date,
       CASE WHEN f.pricing_date IS NULL THEN 'SKU not found' END AS error
FROM req r LEFT JOIN found f ON r.sku_id = f.sku_id""")

SQL["sku_region_map"] = O.with_views(["pricing", "patterns"], f"""
{_SMAP}
SELECT kind, component, region, sku_id FROM smap""")

_disk_cols = ",\n  ".join(
    f"CAST(max(CASE WHEN term = '{t}' THEN pp.{b} END) AS DOUBLE) AS {t}_{b}"
    for t in ("ondemand", "cud_1y", "cud_3y") for b in ("list_price", "account_price"))
SQL["disk_prices"] = O.with_views(["pricing", "patterns"], f"""
{_SMAP},
{_LP},
{_PP},
d AS (
  SELECT regexp_replace(component, '-cud-[13]y$', '') AS disk_type, region,
         CASE WHEN regexp_matches(component, '-cud-1y$') THEN 'cud_1y'
              WHEN regexp_matches(component, '-cud-3y$') THEN 'cud_3y' ELSE 'ondemand' END AS term,
         sku_id
  FROM smap WHERE kind = 'disk'
)
SELECT disk_type, region,
  {_disk_cols}
FROM d LEFT JOIN pp ON d.sku_id = pp.sku_id
GROUP BY disk_type, region""")


def _estimate(specs_cte: str, id_col: str, final_cols: str | None = None, rows: str = "res") -> str:
    nd = "NOT contains(t, 'nvidia') AND NOT regexp_full_match(t, '[0-9]+')"
    reqs = []
    for term, base, suffix in (("ondemand", 0, None), ("cud_1y", 10, "-cud-1y"), ("cud_3y", 20, "-cud-3y")):
        fam = (f"family || '{suffix}'" if suffix else
               "family || CASE WHEN is_custom THEN '-custom' ELSE '-predefined' END")
        sx = suffix or ""
        parts = [
            (base, "cpu", fam, "cpu * 730", "TRUE"),
            (base + 1, "ram", fam, "ram_gb * 730", "TRUE"),
            (base + 2, "gpu", f"gpu_type || '{sx}'", "gpu_count * 730", "gpu_type IS NOT NULL"),
            (base + 3, "disk", "boot_type", "boot_gb", "TRUE"),
            (base + 4, "disk", f"'local-ssd{sx}'", "local_ssd_gb", "has_local_ssd"),
        ]
        for seq, kind, comp, qty, cond in parts:
            reqs.append((seq, term, kind, comp, qty, cond))
    for term, base in (("ondemand", 30), ("cud_3y", 40)):
        reqs.append((base, term, "sku", f"'{C.CONFIDENTIAL_CPU_SKU}'", "cpu * 730", "confidential"))
        reqs.append((base + 2, term, "sku", f"'{C.CONFIDENTIAL_RAM_SKU}'", "ram_gb * 730", "confidential"))
    req_sql = "\n  UNION ALL\n  ".join(
        f"SELECT {id_col}, region, {seq} AS seq, '{term}' AS term, '{kind}' AS kind, {comp} AS component, "
        f"CAST({qty} AS DECIMAL(22,10)) AS qty FROM parsed WHERE parse_status IS NULL AND ({cond})"
        for seq, term, kind, comp, qty, cond in reqs)
    sums = ",\n    ".join(
        f"SUM(CASE WHEN term = '{t}' THEN fee_{b} END) AS {t}_{b}"
        for t in ("ondemand", "cud_1y", "cud_3y") for b in ("l", "a"))
    outs = ",\n  ".join(
        f"CASE WHEN status = 'OK' THEN CAST(round(COALESCE({t}_{b}, 0), 2) AS DOUBLE) END AS {t}_{n}_price"
        for t in ("ondemand", "cud_1y", "cud_3y") for b, n in (("l", "list"), ("a", "account")))
    final = final_cols or f"""{id_col}, region, instance_type, disk_definition AS disk_type,
  '{C.CALCULATION_PERIOD}' AS calculation_period,
  {outs},
  status"""
    return f"""
{_SMAP},
{_LP},
{_PP},
{specs_cte},
p1 AS (SELECT s.*, string_split(COALESCE(machine_definition, ''), '_') AS toks FROM specs s),
p2 AS (
  SELECT *,
    list_filter(toks, lambda t: contains(t, 'nvidia'))[-1] AS gpu_type,
    COALESCE(TRY_CAST(list_filter(toks, lambda t: NOT contains(t, 'nvidia') AND regexp_full_match(t, '[0-9]+'))[-1] AS INTEGER), 0) AS gpu_count,
    len(list_filter(toks, lambda t: {nd} AND contains(t, 'tdx'))) > 0 AS confidential,
    list_filter(toks, lambda t: {nd} AND NOT contains(t, 'tdx'))[-1] AS machine
  FROM p1
),
p3 AS (
  SELECT *, contains(machine, 'custom') AS is_custom, string_split(machine, '-') AS parts,
    CASE WHEN disk_definition IS NULL OR disk_definition = '' THEN NULL ELSE string_split(disk_definition, '_') END AS dtoks
  FROM p2
),
p4 AS (
  SELECT *,
    CASE WHEN machine IS NULL THEN NULL WHEN gpu_type IS NOT NULL
         THEN gpu_type || '_' || CAST(gpu_count AS VARCHAR) || '_' || machine ELSE machine END AS instance_type,
    CASE WHEN len(parts) = 4 THEN parts[1] ELSE 'n1' END AS c_family,
    TRY_CAST(CASE WHEN len(parts) = 4 THEN parts[3] ELSE parts[-2] END AS DECIMAL(20,4)) AS c_cpu,
    CAST(TRY_CAST(CASE WHEN len(parts) = 4 THEN parts[4] ELSE parts[-1] END AS DECIMAL(12,0))
         * CAST('0.0009765625' AS DECIMAL(11,10)) AS DECIMAL(18,10)) AS c_ram,
    CASE WHEN NOT contains(machine, 'custom') THEN
      regexp_replace(regexp_replace(regexp_replace(machine, '-nps4', '', 'g'), '-[0-9]+lssd', '', 'g'), '-ssd[0-9]+t', '', 'g')
    END AS lookup_name,
    list_filter(dtoks, lambda t: contains(t, 'local-ssd'))[-1] AS local_tok,
    list_filter(dtoks, lambda t: NOT contains(t, 'local-ssd'))[-1] AS boot_tok
  FROM p3
),
p5 AS (
  SELECT p4.*,
    CASE WHEN dtoks IS NULL THEN FALSE ELSE local_tok IS NOT NULL END AS has_local_ssd,
    CASE WHEN dtoks IS NOT NULL AND local_tok IS NOT NULL THEN TRY_CAST(string_split(local_tok, '-')[-1] AS INTEGER) END AS local_ssd_gb,
    CASE WHEN dtoks IS NULL THEN 'pd-standard'
         ELSE array_to_string(list_slice(string_split(boot_tok, '-'), 1, len(string_split(boot_tok, '-')) - 1), '-') END AS boot_type,
    CASE WHEN dtoks IS NULL THEN 0 ELSE TRY_CAST(string_split(boot_tok, '-')[-1] AS INTEGER) END AS boot_gb,
    dtoks IS NULL OR boot_tok IS NOT NULL AS boot_present,
    CASE WHEN is_custom THEN c_family ELSE c.family END AS family,
    CASE WHEN is_custom THEN c_cpu ELSE CAST(c.cpu AS DECIMAL(20,4)) END AS cpu,
    CASE WHEN is_custom THEN c_ram ELSE CAST(c.ram_gb AS DECIMAL(18,10)) END AS ram_gb,
    c.family AS cat_family
  FROM p4 LEFT JOIN machine_catalog c ON c.machine_type = p4.lookup_name
),
parsed AS (
  SELECT *,
    CASE WHEN machine IS NULL THEN 'invalid machine definition'
         WHEN is_custom AND (cpu IS NULL OR ram_gb IS NULL) THEN 'invalid custom machine type'
         WHEN NOT is_custom AND cat_family IS NULL THEN 'unknown machine type'
         WHEN NOT boot_present OR boot_gb IS NULL OR (has_local_ssd AND local_ssd_gb IS NULL) THEN 'invalid disk definition'
    END AS parse_status
  FROM p5
),
req AS (
  {req_sql}
),
mapped AS (
  SELECT r.*, CASE WHEN r.kind = 'sku' THEN r.component ELSE m.sku_id END AS sku_id
  FROM req r LEFT JOIN smap m ON m.kind = r.kind AND m.component = r.component AND m.region = r.region
),
priced AS (
  SELECT x.*, CAST(pp.list_price AS DECIMAL(12,6)) AS lp, CAST(pp.account_price AS DECIMAL(12,6)) AS ap
  FROM mapped x LEFT JOIN pp ON pp.sku_id = x.sku_id
),
errs AS (
  SELECT *,
    CASE WHEN kind <> 'sku' AND sku_id IS NULL THEN seq
         WHEN kind = 'sku' AND lp IS NULL THEN seq
         WHEN kind = 'sku' AND ap IS NULL THEN seq + 1 END AS err_seq,
    CASE WHEN kind <> 'sku' AND sku_id IS NULL THEN 'missing sku: ' || kind || ' ' || component || ' in ' || COALESCE(region, 'NULL')
         WHEN kind = 'sku' AND lp IS NULL THEN 'missing list price: ' || sku_id
         WHEN kind = 'sku' AND ap IS NULL THEN 'missing account price: ' || sku_id END AS err_msg,
    COALESCE(lp, 0) * qty AS fee_l, COALESCE(ap, 0) * qty AS fee_a
  FROM priced
),
agg AS (
  SELECT {id_col}, arg_min(err_msg, err_seq) FILTER (WHERE err_msg IS NOT NULL) AS first_error,
    {sums}
  FROM errs GROUP BY {id_col}
),
res AS (
  SELECT p.{id_col}, p.region, p.instance_type, p.disk_definition,
         COALESCE(p.parse_status, a.first_error, 'OK') AS status,
         a.ondemand_l, a.ondemand_a, a.cud_1y_l, a.cud_1y_a, a.cud_3y_l, a.cud_3y_a
  FROM parsed p LEFT JOIN agg a ON p.{id_col} = a.{id_col}
)
SELECT {final}
FROM {rows}"""


SQL["fleet_estimate"] = O.with_views(["pricing", "patterns", "catalog", "fleet"], _estimate(
    "specs AS (SELECT DISTINCT spec_id, machine_definition, disk_definition, region FROM fleet_specs)", "spec_id",
    rows="res JOIN (SELECT spec_id AS listed FROM fleet_specs) f ON f.listed = res.spec_id"))

SQL["machine_comparison"] = O.with_views(["pricing", "patterns", "catalog", "fleet"], _estimate(
    f"specs AS (SELECT DISTINCT machine_definition AS machine_type, machine_definition, "
    f"CAST(NULL AS VARCHAR) AS disk_definition, '{COMPARISON_REGION}' AS region FROM fleet_specs)",
    "machine_type",
    final_cols="""machine_type,
  CASE WHEN status = 'OK' THEN CAST(round(COALESCE(ondemand_l, 0), 2) AS DOUBLE) END AS ondemand_list_price,
  CASE WHEN status = 'OK' THEN CAST(round(COALESCE(ondemand_a, 0), 2) AS DOUBLE) END AS ondemand_account_price,
  CASE WHEN status = 'OK' THEN CAST(round(COALESCE(cud_3y_a, 0), 2) AS DOUBLE) END AS cud_3y_account_price,
  status"""))


# ---------------------------------------------------------------------------------------------
# Monitoring reports and sinks
# ---------------------------------------------------------------------------------------------
_NAT_KEYS = ", ".join(C.NAT_SERIES_LABELS)
_GIB = float(C.BYTES_PER_GIB)
SQL["nat_fee"] = O.with_views(["pricing", "patterns", "metrics"], f"""
{_SMAP},
{_LP},
{_PP},
agg AS (
  SELECT {_NAT_KEYS}, {O.la_date('ts')} AS usage_date,
    SUM(CASE WHEN metric = '{C.NAT_RECEIVED_METRIC}' THEN "value" END) AS rx,
    SUM(CASE WHEN metric = '{C.NAT_SENT_METRIC}' THEN "value" END) AS tx
  FROM metric_points
  WHERE metric IN ('{C.NAT_RECEIVED_METRIC}', '{C.NAT_SENT_METRIC}') AND resource_type = '{C.GCE_INSTANCE}'
  GROUP BY ALL
),
nat AS (
  SELECT m.region, CAST(pp.account_price AS DOUBLE) AS price
  FROM smap m LEFT JOIN pp ON pp.sku_id = m.sku_id
  WHERE m.kind = 'nat' AND m.component = 'nat-data'
),
g AS (
  SELECT {_NAT_KEYS}, usage_date, COALESCE(rx, 0.0) / {_GIB} AS received_bytes_count,
         COALESCE(tx, 0.0) / {_GIB} AS sent_bytes_count
  FROM agg
)
SELECT g.*, nat.price * (g.received_bytes_count + g.sent_bytes_count) AS nat_fee_usd
FROM g LEFT JOIN nat ON g.region = nat.region""")

SQL["ndjson_roundtrip"] = SQL["nat_fee"]

_ALL_LABELS = ", ".join(["project_id", "nat_gateway_name", "region", "psm", "instance_name", "inner_ip",
                         "bucket_name", "storage_class"])
_OC = ", ".join(C.OBJECT_COUNT_GROUP)
SQL["object_count"] = O.with_views(["metrics"], f"""
per_series AS (
  SELECT {_ALL_LABELS}, {O.la_date('ts')} AS usage_date, avg("value") AS m
  FROM metric_points
  WHERE metric = '{C.OBJECT_COUNT_METRIC}' AND resource_type = '{C.GCS_BUCKET}'
  GROUP BY ALL
)
SELECT {_OC}, usage_date, round(avg(m), 6) AS object_count
FROM per_series GROUP BY {_OC}, usage_date""")

SQL["day_replace_table"] = SQL["compute_instance_cost"]

_LBJ = O.with_views(["billing"], f"""
r2_lines AS (
  SELECT billing_account_id AS billing_name, invoice.month AS invoice_month,
         {O.usage_date()} AS usage_date, project.id AS project_id,
         {O.net_cost()} AS total_cost,
         {O.label('forwarding-rule-name')} AS forwarding_rule_name
  FROM billing_export
  WHERE service.id = '{C.COMPUTE_SERVICE_ID}' AND {O.has_label('forwarding-rule-name')}
),
lb AS (
  SELECT billing_name, invoice_month, usage_date, project_id,
         COALESCE(forwarding_rule_name, '--') AS forwarding_rule_name,
         SUM(total_cost) AS SUBTOTAL_USD
  FROM r2_lines
  GROUP BY billing_name, invoice_month, usage_date, project_id, r2_lines.forwarding_rule_name
),
top AS (
  SELECT * FROM lb
  ORDER BY billing_name ASC NULLS FIRST, invoice_month ASC NULLS FIRST, usage_date ASC NULLS FIRST,
           project_id ASC NULLS FIRST, forwarding_rule_name ASC NULLS FIRST
  LIMIT 100
)
SELECT CAST(to_json({{'billing_name': billing_name, 'invoice_month': invoice_month, 'usage_date': usage_date,
  'project_id': project_id, 'forwarding_rule_name': forwarding_rule_name,
  'SUBTOTAL_USD': CAST(SUBTOTAL_USD AS VARCHAR)}}) AS VARCHAR) AS json
FROM top""")
SQL["json_rows"] = _LBJ

SQL["display_rows"] = (_LBJ[:_LBJ.index("  LIMIT 100")] + "  LIMIT 50\n)\nSELECT billing_name, invoice_month, usage_date, project_id, "
                       "forwarding_rule_name, CAST(SUBTOTAL_USD AS DOUBLE) AS SUBTOTAL_USD FROM top")
SQL["compute_instance_cost_from_export"] = SQL["compute_instance_cost"]
SQL["compute_instance_cost_daily"] = SQL["compute_instance_cost_day"]
SQL["fleet_estimate_saved_map"] = SQL["fleet_estimate"]
SQL["compute_instance_cost_from_instants"] = SQL["compute_instance_cost"]
SQL["late_days_recomputed"] = SQL["compute_instance_cost"]
SQL["compute_instance_cost_indexed_day"] = SQL["compute_instance_cost_day"]
SQL["fleet_estimate_versioned_map"] = SQL["fleet_estimate"]
SQL["nat_fee_from_points"] = SQL["nat_fee"]
SQL["object_count_from_points"] = SQL["object_count"]
SQL["comparison_csv"] = SQL["machine_comparison"]
SQL["nat_day_replace"] = f"SELECT * FROM ({SQL['nat_fee']}) WHERE usage_date = DATE '{NAT_DAYS[1]}'"
SQL["spend_having"] = O.with_views(["billing"], f"""
{_accounts(*FULL_RANGE)}
SELECT service.id AS service_id, CAST({_MODES['raw']} AS DOUBLE) AS cost
FROM acct WHERE {_usage_between(*FULL_RANGE)}
GROUP BY service.id HAVING {_MODES['raw']} > 100000000""")
SQL["price_tiers"] = O.with_views(["billing", "pricing"], f"""
req AS (SELECT DISTINCT sku.id AS sku_id FROM billing_export),
snap AS (SELECT * FROM pricing_export WHERE {_NEWEST} {_ONE}),
books AS (
  SELECT sku.id AS sku_id, 'list' AS book, list_price.tiered_rates AS tiers FROM snap
  UNION ALL
  SELECT sku.id, 'account', billing_account_price.tiered_rates FROM snap
),
tiers AS (SELECT sku_id, book, tiers, UNNEST(generate_series(1, len(tiers))) AS i FROM books)
SELECT t.sku_id, t.book, CAST(t.i - 1 AS BIGINT) AS tier, CAST(t.tiers[t.i].start_usage_amount AS DOUBLE) AS start_usage,
       CAST(t.tiers[t.i].usd_amount AS DOUBLE) AS usd
FROM tiers t JOIN req r ON r.sku_id = t.sku_id""")
