"""Temporal joins and picks against brute force."""

import datetime
import random
from decimal import Decimal

from pyspark.sql import functions as F

from periodica.operators.joins import asof_join, interval_bins, interval_join
from periodica.operators.paging import stratified_pick
from periodica.operators.windows import growth_exact, growth_lag, latest_known
from periodica.plans.core import add_usd, core_amounts
from periodica.plans.history import facts_as_of, members_at, membership_sanity, version_intervals
from periodica.plans.quality import cross_check
from periodica.sources.tables import literal_table

DAY = datetime.date


def days(n, seed, span=900):
    rng = random.Random(seed)
    return [DAY(2019, 11, 3) + datetime.timedelta(rng.randrange(span)) for _ in range(n)]


def test_asof_equals_brute_force(spark):
    rng = random.Random(1)
    rates = {(rng.choice("AB"), d): float(i) for i, d in enumerate(days(60, 2))}
    # One key holds most of the left rows, and all of those fall on one day.
    points = [("A", DAY(2020, 12, 31))] * 300 + [(rng.choice("ABC"), d) for d in days(200, 3, 1200)] + [(None, DAY(2020, 1, 1))]
    left = literal_table(spark, [(i, k, d) for i, (k, d) in enumerate(points)], "i int, k string, d date")
    right = literal_table(spark, [(k, d, x) for (k, d), x in rates.items()], "k string, on date, x double")
    got = {r.i: r.x for r in asof_join(left, right, ["k"], "d", "on", "x").collect()}
    want = {}
    for i, (k, d) in enumerate(points):
        known = [(on, x) for (key, on), x in rates.items() if key == k and on <= d]
        want[i] = max(known)[1] if known else None
    assert got == want


def test_interval_edges(spark):
    spans = literal_table(
        spark, [("ENRN", DAY(1996, 1, 2), DAY(2001, 11, 30)), ("ENRN", DAY(2001, 12, 1), None), ("AAPL", DAY(1982, 11, 30), None)],
        "ticker string, start_date date, end_date date")
    dates = literal_table(spark, [(DAY(2001, 11, 29),), (DAY(2001, 11, 30),), (DAY(2024, 12, 31),), (DAY(1982, 11, 30),)], "as_of date")
    got = sorted((str(r.as_of), r.ticker) for r in members_at(spans, dates).collect())
    assert got == [("1982-11-30", "AAPL"), ("2001-11-29", "AAPL"), ("2001-11-29", "ENRN"), ("2001-11-30", "AAPL"),
                   ("2024-12-31", "AAPL"), ("2024-12-31", "ENRN")]
    sane = {str(r.as_of): (r.members, r.plausible) for r in membership_sanity(spans, extra_years=[2024]).collect()}
    assert sane == {"1982-12-31": (1, False), "1996-12-31": (2, False), "2001-12-31": (2, False), "2024-12-31": (2, False)}


def test_interval_join_equals_brute_force(spark):
    rng = random.Random(5)
    spans = [(rng.choice("AB"), a, a + datetime.timedelta(rng.randrange(1, 800)) if rng.random() < 0.8 else None) for a in days(50, 6)]
    points = [(i, rng.choice("AB"), d) for i, d in enumerate(days(80, 7, 1500))]
    left = literal_table(spark, points, "i int, k string, d date")
    right = literal_table(spark, spans, "k string, start_date date, end_date date")
    got = sorted((r.i, r.start_date) for r in interval_join(left, right, "d", by=["k"]).collect())
    want = sorted((i, a) for i, k, d in points for s, a, b in spans if s == k and a <= d and (b is None or b > d))
    assert got == want


def test_interval_join_without_a_key(spark):
    """Lengths from a day to decades, empty and reversed intervals, NULLs, and points on bin borders."""
    rng = random.Random(8)
    starts = days(120, 9, 9000)
    lengths = [rng.choice([-5, 0, 1, 31, 32, 33, 127, 128, 129, 512, 3000, 8000]) for _ in starts]
    spans = [(i, a, a + datetime.timedelta(n) if rng.random() < 0.9 else None) for i, (a, n) in enumerate(zip(starts, lengths))]
    left = literal_table(spark, [(i, d) for i, d in enumerate([*days(60, 10, 9000), None])], "i int, d date")
    right = literal_table(spark, [*spans, (-1, None, DAY(2020, 1, 1)), (-2, None, None)], "k int, start_date date, end_date date")
    got = sorted((r.i, r.k) for r in interval_join(left, right, "d").collect())
    points = [(r.i, r.d) for r in left.collect() if r.d]
    assert got == sorted((i, k) for i, d in points for k, a, b in spans if a <= d and (b is None or b > d))
    assert interval_join(left.where("false"), right, "d").count() == 0
    assert interval_join(left, right.where("false"), "d").count() == 0


def test_an_interval_takes_two_rows_at_most(spark):
    lengths = (0, 1, 31, 32, 33, 127, 128, 129, 400, 3649, 40_000)
    right = literal_table(
        spark, [(i, DAY(2000, 1, 1), DAY(2000, 1, 1) + datetime.timedelta(n)) for i, n in enumerate(lengths)]
        + [(-1, DAY(1900, 1, 1), None), (-2, DAY(2031, 1, 1), None), (-3, None, None)], "k int, start_date date, end_date date")
    bins = interval_bins(right, "start_date", "end_date", F.lit(DAY(1999, 5, 5)), F.lit(DAY(2030, 1, 1)))
    found = {r.k: r["count"] for r in bins.groupBy("k").count().collect()}
    assert set(found) == {*range(len(lengths)), -1} and max(found.values()) <= 2


def test_many_points_of_a_year_are_spread_by_bin(spark):
    left = spark.range(3650).select(F.date_add(F.lit("2000-01-01").cast("date"), F.col("id").cast("int")).alias("d"))
    right = left.select(F.col("d").alias("start_date"), F.date_add("d", 20).alias("end_date"))
    joined = interval_join(left, right, "d")
    assert joined.count() == 3650 * 20 - 19 * 20 // 2
    assert "NestedLoop" not in joined._jdf.queryExecution().executedPlan().toString()
    bins = interval_bins(right, "start_date", "end_date", F.lit(DAY(2000, 1, 1)), F.lit(DAY(2009, 12, 31)))
    assert bins.select("_level", "_bin").distinct().count() > 100


FACTS = "company_id string, fiscal_year int, concept string, value decimal(30,10), filing_date date, period_end date, " \
        "period_start date, source_id string"


def fact_versions(spark):
    rng = random.Random(9)
    rows = [
        (rng.choice("AB"), 2020, rng.choice(["x", "y"]), Decimal(i), filed, ended, None, f"s{i}")
        for i, (filed, ended) in enumerate(zip(days(120, 10, 200), days(120, 11, 250)))
    ]
    return literal_table(spark, rows, FACTS)


def test_version_intervals_agree_with_each_day(spark):
    facts = fact_versions(spark)
    wanted = sorted(set(days(25, 12, 300)))
    dates = literal_table(spark, [(d,) for d in wanted], "as_of date")
    together = {(r.as_of, r.company_id, r.concept): r.source_id for r in facts_as_of(facts, dates).collect()}
    single = {}
    for d in wanted:
        for r in latest_known(facts, d).collect():
            single[(d, r.company_id, r.concept)] = r.source_id
    assert together == single
    spans = version_intervals(facts)
    assert spans.where("known_to <= known_from").count() == 0


def test_a_known_fact_stays_known(spark):
    facts = fact_versions(spark)
    early = {(r.company_id, r.concept): r.filing_date for r in latest_known(facts, "2020-02-01").collect()}
    late = {(r.company_id, r.concept): r.filing_date for r in latest_known(facts, "2020-06-01").collect()}
    assert early and all(late[k] >= d for k, d in early.items())


def test_growth_over_gaps(spark):
    years = literal_table(spark, [("A", 2019, 10.0), ("A", 2020, 20.0), ("A", 2022, 30.0), ("A", 2023, 0.0), ("A", 2024, 5.0)],
                          "k string, y int, v double")
    lag = {r.y: r.v_growth_pct for r in growth_lag(years, ["k"], "y", ["v"]).collect()}
    exact = {r.y: r.v_growth_pct for r in growth_exact(years, ["k"], "y", ["v"]).collect()}
    assert lag == {2019: None, 2020: 100.0, 2022: 50.0, 2023: -100.0, 2024: None}
    assert exact == {2019: None, 2020: 100.0, 2022: None, 2023: -100.0, 2024: None}


CORE = "company_id string, fiscal_year int, period_end date, namespace string, concept string, value decimal(30,10), unit string, " \
       "fiscal_period string, filing_date date, period_start date, source_id string"


def core_rows(spark, *rows):
    end = DAY(2023, 12, 31)
    filled = [("A", 2023, end, ns, tag, Decimal(v), unit, "FY", filed, None, f"s{i}") for i, (ns, tag, v, unit, filed) in enumerate(rows)]
    return literal_table(spark, filled, CORE)


def test_component_revenue_counts_each_part_once(spark):
    facts = core_rows(
        spark,
        ("us-gaap", "OtherRevenue", 10, "USD", DAY(2024, 2, 1)), ("us-gaap", "OtherRevenue", 12, "USD", DAY(2025, 2, 1)),
        ("us-gaap", "RevenueFromSaleOfGoods", 100, "USD", DAY(2024, 2, 1)), ("us-gaap", "InterestIncomeOperating", 7, "USD", DAY(2024, 2, 1)),
    )
    assert core_amounts(facts).first().revenue == 112
    assert core_amounts(facts, component_versions="all").first().revenue == 122


def test_total_revenue_beats_components_and_mapping_by_namespace(spark):
    nci = "StockholdersEquityIncludingPortionAttributableToNoncontrollingInterest"
    facts = core_rows(
        spark,
        ("us-gaap", "OtherRevenue", 500, "USD", DAY(2024, 2, 1)), ("us-gaap", "Revenues", 90, "EUR", DAY(2024, 2, 1)),
        ("us-gaap", nci, 40, "EUR", DAY(2024, 2, 1)), ("dei", nci, 99, "EUR", DAY(2024, 2, 1)),
        ("us-gaap", "LiabilitiesAndStockholdersEquity", 70, "GBP", DAY(2024, 2, 1)),
    )
    fx = literal_table(spark, [("EUR", DAY(2023, 12, 29), Decimal("1.5"))], "currency string, rate_date date, usd_per_unit decimal(24,10)")
    row = add_usd(core_amounts(facts), fx).first()
    assert (row.revenue, row.stockholders_equity, row.total_assets, row.currency) == (90, 40, 70, "EUR")
    assert (row.revenue_usd, row.total_assets_usd, row.net_income_usd) == (135, 105, None)


def test_bank_revenue_alone_gives_no_row(spark):
    assert core_amounts(core_rows(spark, ("us-gaap", "InterestIncomeOperating", 7, "USD", DAY(2024, 2, 1)))).count() == 0


def test_own_mapping(spark):
    mapping = literal_table(spark, [("*", "Turnover", "revenue", "Revenues", None)],
                            "namespace string, concept string, field string, normalized_concept string, combine string")
    facts = core_rows(spark, ("x", "Turnover", 3, "USD", DAY(2024, 2, 1)), ("x", "Revenues", 9, "USD", DAY(2024, 2, 1)))
    assert core_amounts(facts, mapping).first().revenue == 3


def test_cross_check_uses_the_matching_definition(spark):
    ours = literal_table(spark, [("A", "Revenue", 100.0), ("B", "Contracts", 100.0), ("C", "Revenue", 100.0)], "k string, concept string, value double")
    theirs = literal_table(spark, [("A", 104.0, 1.0), ("B", 200.0, 100.0), ("C", 80.0, 80.0)], "k string, total double, operating double")
    got = {r.k: r.within for r in cross_check(ours, theirs, ["k"], 0.05, {"Contracts": "operating"}, "total").collect()}
    assert got == {"A": True, "B": True, "C": False}


def test_stratified_pick_fills_up(spark):
    rows = literal_table(spark, [(i, i % 3) for i in range(40)], "id int, s int")
    strata = {"zero": (F.col("s") == 0, 2), "low": (F.col("id") < 2, None)}
    got = {r.id: r.stratum for r in stratified_pick(rows, "id", strata, 6).collect()}
    assert got == {0: "zero", 3: "zero", 1: "low", 2: "fill", 4: "fill", 5: "fill"}
