"""What jobs shuffle, keep and leave behind: each row once, and nothing that is done with."""

import datetime
import json
import os
import re
import time
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from periodica import session
from periodica.functions import keys
from periodica.operators import writes
from periodica.operators.writes import ParquetTable, insert_new
from periodica.plans import history, ingest, refresh
from periodica.schemas import NATURAL_KEYS, schema
from periodica.session import scratch_dir
from periodica.sources import documents
from periodica.sources.tables import Catalog, literal_table
from periodica.streaming import landing

DAY = datetime.date
FACTS = ("company_id string, fiscal_year int, concept string, value decimal(30,10), unit string, filing_date date, "
         "period_end date, period_start date, source_id string")


@pytest.fixture
def shuffled_joins(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def values(spark, *facts):
    texts = []
    for cik, accn, val in facts:
        item = {"end": "2023-12-31", "val": val, "accn": accn, "fy": 2023, "fp": "FY", "form": "10-K", "filed": "2024-02-01"}
        texts.append((json.dumps({"cik": cik, "facts": {"us-gaap": {"Assets": {"units": {"EUR": [item]}}}}}),))
    return documents.parse_company_facts(spark.createDataFrame(texts, "value string"))


def test_a_sync_leaves_nothing_staged(spark, tmp_path):
    catalog = Catalog(spark, str(tmp_path / "db"))
    companies = documents.parse_universe(spark.createDataFrame([(json.dumps({"data": [["1", "One", "one", "NYSE"]]}),)], "value string"))
    recent = {"accessionNumber": ["0-1"], "filingDate": ["2024-02-01"], "reportDate": ["2023-12-31"], "form": ["10-K"]}
    text = json.dumps({"cik": "1", "filings": {"recent": recent}})
    filings = documents.parse_submissions(spark.createDataFrame([(text,)], "value string"))
    root = scratch_dir(spark).removeprefix("file:")

    def staged():
        return {f for f in os.listdir(root) if f.startswith(("sync-", "facts-", "filings-", "outcomes-", "insert-"))}

    before = staged()
    for day in ("2024-03-01", "2024-03-02"):
        stats = ingest.sync(catalog, companies, filings, values(spark, (1, "0-1", 5), (1, "0-1", 5), (1, "0-2", 6)), "1", day)
    assert (stats["facts"].processed, stats["facts"].inserted, stats["facts"].skipped) == (3, 0, 3)
    assert staged() == before
    facts = catalog.table("financial_facts")
    named = facts.withColumn("again", keys.row_id(F.lit("fact"), *NATURAL_KEYS["financial_facts"]))
    assert facts.count() == 2 and named.where("id = again").count() == 2


def test_columns_that_follow_from_others_are_added_where_rows_are_written(spark, tmp_path):
    t = ParquetTable(spark, str(tmp_path / "t"), schema("financial_facts"), ["fiscal_year"])
    batch = literal_table(spark, [("c", "A", "s", 2020), ("c", "A", "s", 2020), ("c", None, "s", None)],
                          "company_id string, concept string, source_id string, fiscal_year int")
    batch = batch.withColumn("filing_id", F.lit(None).cast("string")).withColumns(
        {c: F.lit(None).cast("date") for c in ("period_start", "period_end")})
    derived = {"id": F.concat("company_id", F.coalesce("concept", F.lit("-")))}
    for new in (2, 0):
        stats = insert_new(t, batch, NATURAL_KEYS["financial_facts"], prune=["fiscal_year"], derived=derived, at_rest=True)
        assert (stats.processed, stats.inserted, stats.skipped) == (3, new, 3 - new)
    assert sorted(r.id for r in t.read().collect()) == ["c-", "cA"]


def test_joins_carry_no_source_ids(spark, shuffled_joins):
    ids = literal_table(spark, [("c1", "CIK", "0000000001"), ("c1", "CIK", "0000000002"), ("c3", "CIK", "0000000003")],
                        "company_id string, identifier_type string, identifier_value string")
    filings = literal_table(spark, [("f1", "c1", "01"), ("f2", "c1", "01"), ("f3", "c3", "09"), ("f4", None, "01")],
                            "id string, company_id string, accession_number string")
    rows = ingest.fact_rows(values(spark, (1, "0-1", 5), (2, "0-1", 6), (3, "0-1", 7), (4, "0-1", 8)), ids, filings, "1")
    text = plan(rows)
    assert sorted((r.cik[-1], r.company_id, r.filing_id or "", r.source_id) for r in rows.collect()) == [
        (n, c, f, "01|us-gaap:Assets|2023-12-31")
        for n, c, f in (("1", "c1", "f1"), ("1", "c1", "f2"), ("2", "c1", "f1"), ("2", "c1", "f2"), ("3", "c3", ""))
    ]
    assert 0 < text.index("AS source_id") < text.index("Join")


def test_relinking_takes_the_facts_once(spark, tmp_path, shuffled_joins):
    ddl = ("id string, company_id string, concept string, period_start date, period_end date, filing_id string, "
           "source_id string, value decimal(30,10)")
    rows = [
        ("linked", "c", "A", None, DAY(2020, 1, 1), "f1", "1|A", Decimal(9)), ("repeats it", "c", "A", None, DAY(2020, 1, 1), None, "1|A", Decimal(1)),
        ("second", "c", "B", None, None, None, "1|B", Decimal(2)), ("first", "c", "B", None, None, None, "1|B", Decimal(1)),
        ("open", "c", "A", None, None, None, "2|A", Decimal(1)), ("open too", "c", "A", None, None, None, "2|A", Decimal(1)),
        ("no company", None, "A", None, None, None, "1|A", Decimal(1)), ("no source", "c", "A", None, None, None, None, Decimal(1)),
        ("linked twice", "c", "C", None, None, "f1", "1|C", Decimal(1)), ("linked twice", "c", "C", None, None, "f1", "1|C", Decimal(1)),
    ]
    table = ParquetTable(spark, str(tmp_path / "relinked-facts"), literal_table(spark, rows, ddl).schema)
    table.replace(literal_table(spark, rows, ddl))
    filings = literal_table(spark, [("f1", "c", "1"), (None, "d", "1")], "id string, company_id string, accession_number string")
    got = landing.relink_filings(table.read(), filings)
    text = plan(got)
    assert sorted((r.id, r.filing_id or "") for r in got.collect()) == [
        ("first", "f1"), ("linked", "f1"), ("linked twice", "f1"), ("linked twice", "f1"), ("no company", ""), ("no source", ""),
        ("open", ""), ("open too", ""),
    ]
    assert text.count("FileScan parquet") == 1 and len(re.findall(r"Exchange hashpartitioning", text)) == 2


def fact_rows(spark):
    rows = [(c, 2020, "x", Decimal(i), "EUR", DAY(2020, 1 + i % 12, 5), DAY(2020, 1 + i % 12, 1), None, f"s{i}")
            for i, c in enumerate("abcabcabc")]
    return literal_table(spark, rows, FACTS)


def test_a_version_carries_each_column_once(spark):
    text = plan(history.version_intervals(fact_rows(spark)))
    line = next(x for x in text.split("\n") if "partial_max(" in x)
    assert len(re.findall(r"source_id#\d+", line)) == len(re.findall(r"value#\d+", line)) == 1


def test_members_and_facts_of_a_contested_ticker(spark, shuffled_joins):
    spans = [("T", "a", DAY(2020, 1, 1), DAY(2020, 6, 1)), ("T", "b", DAY(2020, 3, 1), DAY(2020, 4, 1)), ("T", "a", DAY(2020, 5, 1), None),
             ("U", "c", DAY(2020, 2, 1), DAY(2020, 9, 1)), (None, "c", DAY(2020, 2, 1), None), ("V", None, DAY(2020, 2, 1), None)]
    members = literal_table(spark, spans, "ticker string, company_id string, start_date date, end_date date")
    wanted = [DAY(2020, m, 15) for m in range(1, 13)]
    days = literal_table(spark, [(d,) for d in (*wanted, wanted[0], None)], "as_of date")
    facts = fact_rows(spark)
    got = history.pit_universe(members, facts, days, ["value", "source_id"])
    text, rows, want = plan(got), facts.collect(), []
    for d in wanted:
        for ticker in "TU":
            found = [c for t, c, start, end in spans if t == ticker and c and start <= d and (end is None or d < end)]
            known = [r for r in rows if found and r.company_id == max(found) and r.filing_date <= d]
            if known:
                last = max(known, key=lambda r: r.filing_date)
                want.append((d, ticker, last.company_id, last.source_id))
    assert sorted((r.as_of, r.ticker, r.company_id, r.source_id) for r in got.collect()) == sorted(want) and want
    # The result is not shuffled again: what is dealt by day and ticker has no facts.
    assert not re.search(r"hashpartitioning\(as_of#\d+, ticker#\d+, company_id#\d+", text)


def test_a_refresh_picks_keys_among_what_was_made(spark, tmp_path, monkeypatch):
    rates = ParquetTable(spark, str(tmp_path / "rates"), schema("fx_rates"))
    rates.replace(literal_table(spark, [("EUR", DAY(2020, 1, 1), Decimal(2), "x")], "currency string, rate_date date, usd_per_unit decimal(24,10), source string"))
    facts = ParquetTable(spark, str(tmp_path / "facts"), schema("financial_facts"), ["fiscal_year"])
    batch = fact_rows(spark).withColumns({"concept": F.lit("Assets"), "namespace": F.lit("us-gaap"), "fiscal_period": F.lit("FY")})
    facts.append(batch.where("company_id = 'a'"))
    core = refresh.core_table(facts, rates, str(tmp_path / "core"))
    refresh.refresh_core_table(core, facts, rates)
    facts.append(batch.where("company_id <> 'a'"))
    plans, write = [], ParquetTable.replace_partitions
    monkeypatch.setattr(ParquetTable, "replace_partitions", lambda self, df, *args: plans.append(plan(df)) or write(self, df, *args))
    refresh.refresh_core_table(core, facts, rates)
    assert core.read().count() == refresh.core_financials(facts.read(), rates.read()).count()
    # Facts are folded before they meet the changed keys.
    assert "partial_max(" in plans[0].split("LeftSemi", 1)[1]


def shuffled_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


def left_behind(spark, before):
    """Files shuffled since, once those that are being removed are gone."""
    for _ in range(50):
        if not (new := shuffled_files(spark) - before):
            break
        time.sleep(0.1)
    return new


def facts_of(spark, n, years=(2020,)):
    rows = [(f"c{i % 7}", f"C{i % 3}", f"s{i}", years[i % len(years)]) for i in range(n)]
    batch = literal_table(spark, rows, "company_id string, concept string, source_id string, fiscal_year int")
    return batch.withColumn("filing_id", F.lit(None).cast("string")).withColumns(
        {c: F.lit(None).cast("date") for c in ("period_start", "period_end")})


def test_writes_remove_what_they_shuffled(spark, tmp_path, shuffled_joins):
    before = shuffled_files(spark)
    t = ParquetTable(spark, str(tmp_path / "t"), schema("financial_facts"), ["fiscal_year"], ["company_id"])
    batch = facts_of(spark, 50)  # kept, as a plan that is still in use holds its shuffles
    for _ in range(2):
        insert_new(t, batch, NATURAL_KEYS["financial_facts"], prune=["fiscal_year"])
    p = ParquetTable(spark, str(tmp_path / "p"), schema("filings"))
    insert_new(p, batch.select(F.col("source_id").alias("accession_number")), ["accession_number"])
    assert not left_behind(spark, before)
    assert spark.conf.get(session._CLEANUP, None) is None and not session._INSIDE


def test_releasing_ends_with_the_last_of_those_inside(spark):
    first, second = session.releasing(spark), session.releasing(spark)
    first.__enter__(), second.__enter__(), first.__exit__(None, None, None)
    assert spark.conf.get(session._CLEANUP) == "true"
    second.__exit__(None, None, None)
    assert spark.conf.get(session._CLEANUP, None) is None


def test_rounds():
    assert writes.rounds([]) == [[]] and writes.rounds([("a", 0)]) == [["a"]]
    most = writes.ROUND_ROWS
    assert writes.rounds([("a", most), ("b", 1), ("c", most - 1), ("d", 2 * most), ("e", 1)]) == [["a"], ["b", "c"], ["d"], ["e"]]


@pytest.mark.parametrize("at_rest", [True, False])
def test_an_insert_goes_through_years_in_rounds(spark, tmp_path, monkeypatch, at_rest):
    monkeypatch.setattr(writes, "ROUND_ROWS", 4)
    t = ParquetTable(spark, str(tmp_path / "t"), schema("financial_facts"), ["fiscal_year"], ["company_id"])
    batch = facts_of(spark, 12, (2019, 2020, None))
    twice, written, write = batch.unionByName(batch.where("fiscal_year = 2020")), [], ParquetTable._write
    monkeypatch.setattr(ParquetTable, "_write", lambda self, df, *args: written.append(n := write(self, df, *args)) or n)
    for new, each in ((12, [4, 4, 4]), (0, [0, 0, 0])):
        stats = insert_new(t, twice, NATURAL_KEYS["financial_facts"], prune=["fiscal_year"], at_rest=at_rest)
        assert (stats.processed, stats.inserted, stats.skipped) == (16, new, 16 - new)
        assert written == each
        written.clear()
    assert len(t.segments()) == 2, "one for each insert"
    assert sorted(r.source_id for r in t.read().collect()) == sorted(f"s{i}" for i in range(12))


def test_a_failed_round_stores_nothing(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(writes, "ROUND_ROWS", 1)
    t = ParquetTable(spark, str(tmp_path / "t"), schema("financial_facts"), ["fiscal_year"])
    batch = facts_of(spark, 6, (2019, 2020)).withColumn(
        "unit", F.when(F.col("fiscal_year") == 2020, F.raise_error(F.lit("broken"))).cast("string"))
    stats = writes.insert_guarded(t, batch, NATURAL_KEYS["financial_facts"], prune=["fiscal_year"], at_rest=True)
    assert stats.error and stats.inserted == 0 and t.read().count() == 0 and t.version() == 0


def test_keys_that_cannot_be_null_are_shuffled_no_further(spark, tmp_path, shuffled_joins):
    t = ParquetTable(spark, str(tmp_path / "t"), schema("financial_facts"))
    t.replace(facts_of(spark, 3))
    batch = facts_of(spark, 9).withColumn("source_id", F.concat_ws("|", "source_id", "concept"))
    keys_of = NATURAL_KEYS["financial_facts"]
    fresh = writes.flag_existing(writes.first_per_key(batch, keys_of), t.read(), keys_of).where(~F.col("_exists")).select(*batch.columns)
    assert len(re.findall(r"Exchange hashpartitioning", plan(fresh))) == 2
    assert fresh.count() == 9


def test_facts_of_a_company_share_a_file(spark, tmp_path):
    t = ParquetTable(spark, str(tmp_path / "t"), schema("financial_facts"), ["fiscal_year"], ["company_id"])
    rows = spark.range(0, 40000, 1, 8).select(
        F.sha2((F.col("id") % 40).cast("string"), 256).alias("company_id"), F.sha2(F.col("id").cast("string"), 256).alias("source_id"),
        F.lit(2020).alias("fiscal_year"))
    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(name, "1m")
    try:
        t.replace(rows)
    finally:
        spark.conf.unset(name)
    found = t.read().withColumn("file", F.input_file_name()).groupBy("company_id").agg(
        F.count_distinct("file").alias("files"), F.max("file").alias("file")).collect()
    assert len(found) == 40 and {r.files for r in found} == {1} and len({r.file for r in found}) > 1


def test_a_large_delivery_is_synced_in_rounds(spark, tmp_path, monkeypatch):
    def synced(name):
        catalog = Catalog(spark, str(tmp_path / name))
        listed = [[str(i), f"N{i}", f"t{i}", "NYSE"] for i in range(1, 12)]
        companies = documents.parse_universe(spark.createDataFrame([(json.dumps({"data": listed}),)], "value string"))
        texts = [(json.dumps({"cik": str(i), "filings": {"recent": {
            "accessionNumber": [f"{i}-1"], "filingDate": ["2024-02-01"], "reportDate": ["2023-12-31"], "form": ["10-K"]}}}),) for i in range(1, 8)]
        filings = documents.parse_submissions(spark.createDataFrame(texts, "value string"))
        docs = []
        for i in range(1, 14):  # two of them of unknown companies
            items = [{"end": f"{year}-12-31", "start": start, "val": val, "accn": f"{i}-1", "fp": "FY", "form": "10-K"}
                     for year, start, val in ((2020, "2020-01-01", 1), (2021, "2021-12-31", 2), (2021, None, "n/a"), (1985, None, 3), (2020, "2020-01-01", 1))]
            docs.append((json.dumps({"cik": str(i), "facts": {"us-gaap": {"Assets": {"units": {"EUR": items}}}}}),))
        values = documents.parse_company_facts(spark.createDataFrame(docs, "value string"))
        for day in ("2024-03-01", "2024-03-02"):
            stats = ingest.sync(catalog, companies, filings, values, "1", day)
        assert (stats["facts"].processed, stats["facts"].inserted, stats["facts"].skipped) == (44, 0, 44)
        return [sorted(map(str, catalog.table(t).drop("run_id").collect())) for t in ("financial_facts", "fact_rejects", "document_outcomes", "filings")]

    whole = synced("whole")
    assert len(whole[0]) == 22 and len(whole[1]) == 11
    monkeypatch.setattr(writes, "ROUND_ROWS", 20)
    staged, write = [], ingest.written
    monkeypatch.setattr(ingest, "written", lambda df, path, *args: staged.append(re.sub(".*/|-.*", "", path)) or write(df, path, *args))
    assert synced("in rounds") == whole
    assert staged.count("values") == 2 and staged.count("facts") > 4
    ids = [r.id for r in Catalog(spark, str(tmp_path / "whole")).table("financial_facts").collect()]
    assert {len(i) for i in ids} == {32} and len(set(ids)) == len(ids)


def test_years_are_relinked_in_rounds_where_keys_stay_in_one(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(writes, "ROUND_ROWS", 3)
    ddl = ("id string, company_id string, concept string, period_start date, period_end date, filing_id string, "
           "source_id string, value decimal(30,10), fiscal_year int")
    rows = [(f"{y}{i}", "c", "A", None, DAY(y, 12, 31), None, f"{n}|A", Decimal(i), y)
            for y in (2019, 2020, 2021, 2022) for i, n in enumerate("112" if y < 2022 else "223")]
    rows.append(("open", "c", "A", None, None, None, "1|A", Decimal(1), None))
    filings = literal_table(spark, [("f1", "c", "1")], "id string, company_id string, accession_number string")
    written, write = [], ParquetTable._write
    monkeypatch.setattr(ParquetTable, "_write", lambda self, df, *args: written.append(n := write(self, df, *args)) or n)

    def relinked(name, rows):
        facts = ParquetTable(spark, str(tmp_path / name), schema("financial_facts"), ["fiscal_year"], ["company_id"])
        facts.replace(literal_table(spark, rows, ddl))
        written.clear()
        assert landing.relink_table(facts, filings) == sum(written)
        return sorted((r.id, r.filing_id) for r in facts.read().collect() if r.filing_id)

    first = [(f"{y}0", "f1") for y in (2019, 2020, 2021)]
    assert relinked("apart", rows) == [*first, ("open", "f1")] and written == [1, 2, 2, 2]
    # A fact of a year that is not its period's may repeat one of another year, so all years are looked at together.
    strays = [*rows, ("stray", "c", "A", None, DAY(2019, 12, 31), None, "1|A", Decimal(-1), 2020)]
    assert relinked("strays", strays) == [*first[1:], ("open", "f1"), ("stray", "f1")] and len(written) == 1
