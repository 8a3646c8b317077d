"""Every registered query against its oracle, and the shape of the hot plans."""

import re
from uuid import uuid4

import pytest

import __spark_entry__ as contract
from periodica.plans import ingest
from periodica.session import scratch_dir
from periodica.workload.registry import load
from periodica.workload.views import Views
from tests.oracle import compare, connect

FOLDER = "/root/testdata/sf0.001"
WRITING = {"insert_table", "insert_table_counters", "snapshot_refresh", "overwrite_issues", "incremental_landing",
           "batch_counters", "sync_companies"}


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(load()))
def test_query_equals_oracle(spark, con, name):
    # Some faults are too rare to show on the smallest data.
    assert compare(spark, con, name, load()[name], FOLDER) in (None, "both empty")


def test_sync_documents_loads_filings_and_facts(spark, monkeypatch):
    seen, sync = [], ingest.sync
    monkeypatch.setattr(ingest, "sync", lambda *args, **options: seen.append(out := sync(*args, **options)) or out)
    load()["sync_documents"].build(Views(spark, FOLDER)).count()
    assert len(seen) == 1 and seen[0]["filings"].inserted > 0 and seen[0]["facts"].inserted > 0


def test_contract(spark):
    assert contract.entry(spark).count() > 0
    assert set(load()) <= set(contract.oracle_sql()) <= set(contract.queries())


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_core_aggregates_facts_once(spark):
    """Mapping broadcast, hash aggregate, and no shuffle of single facts."""
    from periodica.plans.core import core_amounts

    text = plan(core_amounts(Views(spark, FOLDER)["financial_facts"], component_versions="all"))
    assert "SortAggregate" not in text and "SortMergeJoin" not in text
    assert len(re.findall(r"Exchange hashpartitioning", text)) == 1


def test_first_row_picks_are_trimmed_before_the_shuffle(spark):
    from periodica.operators.windows import latest_known

    text = plan(latest_known(Views(spark, FOLDER)["financial_facts"], "1999-06-30"))
    assert text.count("WindowGroupLimit") == 2


def test_no_plan_has_a_cartesian_product(spark):
    views = Views(spark, FOLDER)
    for name, query in load().items():
        # Queries that write do so while they are built; what they read back is a scan.
        if query.build.__module__.endswith("stored") or name in WRITING:
            continue
        text = plan(query.build(views))
        assert "CartesianProduct" not in text, name
        assert "BroadcastNestedLoopJoin" not in text, name


@pytest.mark.parametrize("name", ["facts_ingest", "facts_rejected", "companyfacts_explode"])
def test_documents_are_parsed_once(spark, name):
    assert plan(load()[name].build(Views(spark, FOLDER))).count("from_json") == 1


def test_point_in_time_reads_wanted_columns_only(spark):
    from periodica.operators.writes import ParquetTable
    from periodica.plans.history import facts_as_of

    views = Views(spark, FOLDER)
    facts = views["financial_facts"]
    table = ParquetTable(spark, f"{scratch_dir(spark)}/pit-columns-{uuid4().hex}", facts.schema)
    table.replace(facts)
    days = spark.sql("SELECT DATE '1999-06-30' AS as_of")
    text = plan(facts_as_of(table.read(), days, columns=["value"]))
    read = " ".join(re.findall(r"FileScan parquet \[([^\]]*)\]", text))
    assert "value" in read and "created_at" not in read and "namespace" not in read and "provider_id" not in read


def test_asof_join_needs_one_join(spark):
    from periodica.plans.core import add_usd, core_amounts

    views = Views(spark, FOLDER)
    amounts = core_amounts(views["financial_facts"])
    assert plan(add_usd(amounts, views["fx_rates"])).count("LeftOuter") == 1


@pytest.mark.parametrize("versions", ["all", "latest"])
def test_core_financials_scan_stored_facts_once(spark, versions):
    from periodica.operators.writes import ParquetTable
    from periodica.plans.core import core_financials

    views = Views(spark, FOLDER)
    facts = views["financial_facts"]
    table = ParquetTable(spark, f"{scratch_dir(spark)}/core-scans-{uuid4().hex}", facts.schema)
    table.replace(facts)
    text = plan(core_financials(table.read(), views["fx_rates"], component_versions=versions))
    assert text.count("core-scans") == len(re.findall(r"FileScan parquet \[[^\]]*concept", text)) == 1
    assert "Subquery" not in text
    # The rates come to the amounts, which are shuffled for the aggregates only.
    assert text.count("LeftOuter") == 1 and text.count("BroadcastExchange") >= 1
    assert not re.search(r"Exchange hashpartitioning\(currency#\d+, \d+\), ENSURE_REQUIREMENTS.*\n.*HashAggregate\(keys=\[company_id", text)


def test_stub_companies_run_nothing_while_built(spark):
    from periodica.plans import audit

    tracker = spark.sparkContext.statusTracker()
    views = {n: Views(spark, FOLDER)[n] for n in ("financial_facts", "filings", "company_identifiers", "company_listings", "companies")}
    before = len(tracker.getJobIdsForGroup())
    audit.stub_companies(views)
    assert len(tracker.getJobIdsForGroup()) == before


def test_integrity_audit_reads_facts_once(spark):
    from periodica.plans import audit
    from periodica.sources.tables import Catalog

    views = Views(spark, FOLDER)
    names = ("financial_facts", "filings", "companies", "company_identifiers", "company_listings", "exchanges")
    catalog = Catalog(spark, f"{scratch_dir(spark)}/audited-{uuid4().hex}")
    tables = {}
    for name in names:
        catalog.store(name).replace(views[name])
        tables[name] = catalog.table(name)
    text = plan(audit.integrity_audit(tables))
    assert len(re.findall(r"FileScan parquet \[[^\]]*source_id", text)) == 1
