"""Derived layers: canonical facts, core financials, currency rates, quality."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from periodica import constants
from periodica.operators.joins import asof_join
from periodica.plans import core, ingest, quality
from periodica.sources.series import fx_from_pairs
from periodica.workload.registry import query
from periodica.workload.views import Views


def _values(name: str, columns: int) -> str:
    """A packaged table as a VALUES list for the oracle."""
    quote = lambda cell: "NULL" if cell is None else f"'{cell}'"
    return ", ".join("(" + ", ".join(quote(c) for c in row[:columns]) + ")" for row in constants.rows(name)[1:])


MAPPING = f"cn(namespace, concept, field, normalized_concept, combine) AS (VALUES {_values('tag_mapping', 5)})"
CODES = f"codes(code) AS (VALUES {_values('currencies', 1)})"
MATCH = "cn.concept = ff.concept AND (cn.namespace = '*' OR cn.namespace = ff.namespace)"

_FIELDS = ", ".join(f"'{f}'" for f in ("revenue", *constants.CORE_FIELDS.values()))
_BEST = ", ".join(
    f"max(CASE field WHEN '{field}' THEN value END) AS {name}" for name, field in constants.CORE_FIELDS.items()
)
_USD = ",\n".join(
    f"c.{m}, CASE WHEN c.currency = 'USD' THEN CAST(c.{m} AS DOUBLE) "
    f"ELSE CAST(c.{m} AS DOUBLE) * CAST(r.usd_per_unit AS DOUBLE) END AS {m}_usd"
    for m in constants.CORE_METRICS
)


def _core_sql(versions: str) -> str:
    """Tagged facts to yearly rows; ``versions`` picks the component rows to add up."""
    return f"""
        {MAPPING}, {CODES},
        tagged AS (SELECT ff.*, cn.field, cn.combine, codes.code AS money FROM {{financial_facts}} ff JOIN cn ON {MATCH}
                   LEFT JOIN codes ON codes.code = ff.unit WHERE ff.fiscal_period = 'FY' AND cn.field IN ({_FIELDS})),
        summed AS (SELECT company_id, fiscal_year, period_end, sum(value) AS parts FROM ({versions}) x GROUP BY ALL),
        yearly AS (SELECT company_id, fiscal_year, period_end, {_BEST},
                          max(CASE WHEN field = 'revenue' AND combine IS NULL THEN value END) AS reported,
                          max(CASE WHEN field = 'revenue' AND combine IS NULL THEN money END) AS revenue_money,
                          max(CASE WHEN field = 'total_assets' THEN money END) AS assets_money
                   FROM tagged GROUP BY ALL),
        core AS (SELECT company_id, fiscal_year, period_end, coalesce(reported, parts) AS revenue,
                        {", ".join(constants.CORE_FIELDS)}, coalesce(revenue_money, assets_money) AS currency
                 FROM yearly LEFT JOIN summed USING (company_id, fiscal_year, period_end))"""


_ALL_PARTS = "SELECT * FROM tagged WHERE combine = 'sum'"
_LATEST_PARTS = """SELECT * FROM tagged WHERE combine = 'sum' QUALIFY row_number() OVER (
            PARTITION BY company_id, fiscal_year, period_end, concept, namespace, unit, period_start
            ORDER BY filing_date DESC, source_id DESC, value DESC) = 1"""
CORE = _core_sql(_ALL_PARTS)
WITH_USD = f"""SELECT c.company_id, c.fiscal_year, c.period_end, {_USD}, c.currency
        FROM core c ASOF LEFT JOIN {{fx_rates}} r ON r.currency = c.currency AND c.period_end >= r.rate_date"""
AMOUNTS = " ".join(x for m in constants.CORE_METRICS for x in (m, f"{m}_usd"))
METRICS = " ".join(constants.CORE_METRICS)


def core_all(v: Views) -> DataFrame:
    return core.core_amounts(v["financial_facts"], component_versions="all")


@query(f"WITH {CORE} {WITH_USD}", doubles=AMOUNTS)
def core_financials(v: Views) -> DataFrame:
    """Yearly core financials with dollars; revenue parts as filed, each filing counted."""
    return core.core_financials(v["financial_facts"], v["fx_rates"], component_versions="all")


@query(f"WITH {_core_sql(_LATEST_PARTS)} {WITH_USD}", doubles=AMOUNTS)
def core_financials_latest_parts(v: Views) -> DataFrame:
    """The same with every revenue part counted once, from its latest filing."""
    return core.core_financials(v["financial_facts"], v["fx_rates"])


@query(
    f"""WITH {MAPPING}
    SELECT ff.company_id, ff.fiscal_year, ff.fiscal_period, ff.period_end, ff.namespace, ff.concept, ff.source_id,
           ff.value, ff.unit, cn.field, cn.normalized_concept, cn.combine
    FROM {{financial_facts}} ff JOIN cn ON {MATCH}""",
    doubles="value",
)
def facts_normalized(v: Views) -> DataFrame:
    return core.normalized_facts(v["financial_facts"]).select(
        "company_id", "fiscal_year", "fiscal_period", "period_end", "namespace", "concept", "source_id",
        "value", "unit", "field", "normalized_concept", "combine",
    )


@query(
    f"""WITH {CORE}
    SELECT company_id, fiscal_year, period_end, total_assets,
           coalesce(total_liabilities, total_assets - stockholders_equity) AS liabilities_effective,
           (total_liabilities IS NULL AND total_assets IS NOT NULL AND stockholders_equity IS NOT NULL)
             AS liabilities_derived,
           stockholders_equity, cash
    FROM core""",
    doubles="total_assets liabilities_effective stockholders_equity cash",
)
def balance_effective(v: Views) -> DataFrame:
    return core.balance_effective(core_all(v))


@query(
    """SELECT o.o_orderkey, o.currency, CAST(o.o_orderdate AS DATE) AS day, r.usd_per_unit
    FROM (SELECT o_orderkey, o_orderdate,
                 CASE o_orderstatus WHEN 'O' THEN 'EUR' WHEN 'P' THEN 'GBP' ELSE 'USD' END AS currency
          FROM {orders}) o
    LEFT JOIN LATERAL (SELECT usd_per_unit FROM {fx_rates} r
                       WHERE r.currency = o.currency AND r.rate_date <= o.o_orderdate
                       ORDER BY r.rate_date DESC LIMIT 1) r ON true""",
    doubles="usd_per_unit",
)
def fx_asof(v: Views) -> DataFrame:
    """Latest rate on or before the day of every order."""
    status = F.col("o_orderstatus")
    left = v["orders"].select(
        "o_orderkey", F.when(status == "O", "EUR").when(status == "P", "GBP").otherwise("USD").alias("currency"),
        F.col("o_orderdate").cast("date").alias("day"),
    )
    return asof_join(left, v["fx_rates"], ["currency"], "day", "rate_date", "usd_per_unit")


@query(
    """SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, CAST(l.l_shipdate AS DATE) AS day, p.o_totalprice AS last_order
    FROM {lineitem} l
    LEFT JOIN LATERAL (
      SELECT max(o.o_totalprice) AS o_totalprice FROM {orders} o
      WHERE o.o_custkey = l.l_suppkey AND o.o_orderdate <= l.l_shipdate
      GROUP BY o.o_orderdate ORDER BY o.o_orderdate DESC LIMIT 1) p ON true""",
    doubles="last_order",
)
def asof_by_key(v: Views) -> DataFrame:
    """The as-of join on a wide key range: last order value of a customer before each shipping day."""
    left = v["lineitem"].select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_shipdate").cast("date").alias("day")
    )
    right = v["orders"].select(
        F.col("o_custkey").alias("l_suppkey"), "o_orderdate", F.col("o_totalprice").alias("last_order")
    )
    return asof_join(left, right, ["l_suppkey"], "day", "o_orderdate", "last_order")


_CROSS = """SELECT p.currency, p.rate_date, u.per_eur / p.per_eur AS usd_per_unit
    FROM {per_eur} p JOIN {per_eur} u ON u.rate_date = p.rate_date AND u.currency = 'USD'
    WHERE p.currency NOT IN ('USD', 'EUR') AND p.per_eur > 0
    UNION ALL
    SELECT 'EUR', rate_date, per_eur FROM {per_eur} WHERE currency = 'USD'"""
_PAIRS = """SELECT CASE WHEN currency = 'AED' THEN 'USDAED' WHEN currency = 'JPY' THEN 'JPYUSD' ELSE 'GBPUSD' END AS pair,
           rate_date, per_eur AS close FROM {per_eur} WHERE currency <> 'USD'"""


def pair_closes(v: Views) -> DataFrame:
    code = F.col("currency")
    return v["per_eur"].where("currency <> 'USD'").select(
        F.when(code == "AED", "USDAED").when(code == "JPY", "JPYUSD").otherwise("GBPUSD").alias("pair"),
        "rate_date", F.col("per_eur").alias("close"),
    )


@query(_CROSS, doubles="usd_per_unit")
def fx_cross(v: Views) -> DataFrame:
    """Dollar rates crossed through the euro."""
    return ingest.fx_cross(v["per_eur"])


@query(
    f"""WITH closes AS ({_PAIRS})
    SELECT substr(pair, 1, 3) AS currency, rate_date, close AS usd_per_unit FROM closes
    WHERE pair LIKE '%USD' AND close > 0
    UNION ALL
    SELECT substr(pair, 4, 3), rate_date, 1.0 / close FROM closes WHERE pair LIKE 'USD%' AND close > 0""",
    doubles="usd_per_unit",
)
def fx_pairs(v: Views) -> DataFrame:
    """Dollar rates from pair closes, inverted where only that direction exists."""
    return fx_from_pairs(pair_closes(v), v["per_eur"].select("currency"))


@query(
    f"""WITH crossed AS ({_CROSS}), closes AS ({_PAIRS})
    SELECT currency, rate_date, usd_per_unit, 'ecb' AS source FROM crossed WHERE currency IN ('GBP', 'JPY', 'EUR')
    UNION ALL
    SELECT 'AED', rate_date, 1.0 / close, 'pairs' FROM closes WHERE pair = 'USDAED' AND close > 0""",
    doubles="usd_per_unit",
)
def fx_choice(v: Views) -> DataFrame:
    """Published rates per currency, the pair feed only for currencies without any."""
    return ingest.choose_fx(
        ingest.fx_cross(v["per_eur"]), fx_from_pairs(pair_closes(v), v["per_eur"].select("currency"))
    )


_LATEST = f"""WITH {CORE},
    latest AS (SELECT *, CAST(abs(total_assets - (coalesce(total_liabilities, total_assets - stockholders_equity)
                                                  + stockholders_equity)) AS DOUBLE)
                         / nullif(CAST(total_assets AS DOUBLE), 0) AS gap
               FROM core WHERE fiscal_year >= 1996
               QUALIFY row_number() OVER (PARTITION BY company_id, fiscal_year ORDER BY period_end DESC) = 1)"""
def _issue(name: str, field: str, severity: str, value: str, condition: str) -> str:
    return (
        f"SELECT company_id, fiscal_year, '{field}' AS field, '{name}' AS issue_type, '{severity}' AS severity, "
        f"CAST({value} AS DOUBLE) AS value FROM latest WHERE {condition}"
    )


_MARGIN = "revenue > 0 AND CAST(gross_profit AS DECIMAL(38,10)) > CAST(revenue AS DECIMAL(28,10)) * 1.01"
_ISSUES = {
    "negative_revenue": _issue("negative_revenue", "revenue", "error", "revenue", "revenue < 0"),
    "unbalanced": _issue("unbalanced", "balance", "error", "gap", "gap > 0.01"),
    "absurd_margin": _issue("absurd_margin", "gross_margin", "error", "gross_profit", _MARGIN),
    "future_date": _issue("future_date", "period_end", "warning", "year(period_end)", "period_end > DATE '2000-06-30'"),
    "zero_revenue": _issue("zero_revenue", "revenue", "warning", "0", "revenue = 0"),
}


@query(_LATEST + " UNION ALL ".join(_ISSUES.values()), doubles="value")
def quality_issues(v: Views) -> DataFrame:
    """All five plausibility checks in one pass."""
    return quality.quality_issues(core_all(v), 1996, "1998-06-30")


@query(f"{_LATEST} {_ISSUES['unbalanced']}", doubles="value")
def quality_unbalanced(v: Views) -> DataFrame:
    return quality.issues(core_all(v), "unbalanced", 1996)


@query(
    f"""WITH {CORE},
    latest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY company_id ORDER BY period_end DESC) AS rn
               FROM core) r WHERE rn = 1)
    SELECT count(*) AS companies,
           count(*) FILTER (WHERE {" AND ".join(f"{m} IS NOT NULL" for m in constants.CORE_METRICS)}) AS complete,
           {", ".join(f"count(*) FILTER (WHERE {m} IS NULL) AS missing_{m}" for m in constants.CORE_METRICS)}
    FROM latest""",
    longs="companies complete " + " ".join(f"missing_{m}" for m in constants.CORE_METRICS),
)
def field_coverage(v: Views) -> DataFrame:
    return quality.field_coverage(core_all(v))


@query(
    """WITH ours AS (SELECT company_id, fiscal_year, concept, max(value) AS value FROM {financial_facts}
                     WHERE concept IN ('Revenues', 'SalesRevenueNet') GROUP BY 1, 2, 3),
    theirs AS (SELECT o_custkey AS company_id, CAST(year(o_orderdate) AS INT) AS fiscal_year, max(o_totalprice) AS total,
                      avg(o_totalprice) AS operating FROM {orders} GROUP BY 1, 2),
    chosen AS (SELECT company_id, fiscal_year, concept, CAST(value AS DOUBLE) AS value,
                      CASE concept WHEN 'SalesRevenueNet' THEN operating ELSE total END AS other_value
               FROM ours JOIN theirs USING (company_id, fiscal_year))
    SELECT *, abs(value - other_value) / nullif(abs(other_value), 0) * 100 AS diff_pct,
           abs(value - other_value) / nullif(abs(other_value), 0) * 100 <= 50.0 AS within
    FROM chosen""",
    doubles="value other_value diff_pct",
)
def cross_check(v: Views) -> DataFrame:
    """Revenue against a second source, compared with the column of the same definition."""
    ours = v["financial_facts"].where(F.col("concept").isin("Revenues", "SalesRevenueNet")).groupBy(
        "company_id", "fiscal_year", "concept"
    ).agg(F.max("value").alias("value"))
    theirs = v["orders"].groupBy(F.col("o_custkey").alias("company_id"), F.year("o_orderdate").alias("fiscal_year")).agg(
        F.max("o_totalprice").alias("total"), F.avg("o_totalprice").alias("operating")
    )
    return quality.cross_check(
        ours, theirs, ["company_id", "fiscal_year"], 0.5, {"SalesRevenueNet": "operating"}, "total"
    )
