"""Stored tables: idempotent inserts, upserts, patches, snapshots, runs, landing, sync."""

import datetime
import json
import re
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from periodica import constants
from periodica.operators.writes import (
    Overlap, ParquetTable, WriteStats, backfill_currency, backfill_table, insert_guarded, insert_new, mark, patch,
    refresh_snapshot, replace_where, upsert,
)
from periodica.plans import history, ingest, refresh, runs
from periodica.plans.core import core_financials
from periodica.schemas import NATURAL_KEYS, TABLES, schema
from periodica.sources import documents
from periodica.sources.tables import Catalog, literal_table
from periodica.streaming import landing

DAY = datetime.date
ROW = "k string, n int, v string"


def table(spark, tmp_path, ddl=ROW, name="t"):
    from pyspark.sql.types import StructType

    return ParquetTable(spark, str(tmp_path / name), StructType.fromDDL(ddl))


def content(t):
    return sorted(tuple(r) for r in t.read().collect())


def test_insert_is_idempotent_and_null_safe(spark, tmp_path):
    t = table(spark, tmp_path)
    batch = literal_table(spark, [("a", None, "2"), ("a", None, "1"), ("a", 1, "x"), (None, None, "y")], ROW)
    assert insert_new(t, batch, ["k", "n"]) == WriteStats(processed=4, inserted=3, skipped=1)
    assert insert_new(t, batch, ["k", "n"]) == WriteStats(processed=4, inserted=0, skipped=4)
    more = literal_table(spark, [("a", None, "3"), ("b", None, "z")], ROW)
    assert insert_new(t, more, ["k", "n"]) == WriteStats(processed=2, inserted=1, skipped=1)
    assert {(r[0], r[1], r[2]) for r in t.read().collect()} == {
        ("a", None, "1"), ("a", 1, "x"), (None, None, "y"), ("b", None, "z")}


def test_insert_keeps_the_first_in_order(spark, tmp_path):
    t = table(spark, tmp_path, "k string, at int, v string")
    batch = literal_table(spark, [("a", 2, "x"), ("a", 1, "y"), ("a", None, "z")], "k string, at int, v string")
    insert_new(t, batch, ["k"], order=["at"])
    assert content(t) == [("a", 1, "y")]


def test_one_hot_key_counts_every_copy(spark, tmp_path):
    t = table(spark, tmp_path)
    batch = spark.range(30000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"),
                                      F.lit(1).alias("n"), F.col("id").cast("string").alias("v"))
    assert insert_new(t, batch, ["k", "n"]) == WriteStats(processed=30000, inserted=20001, skipped=9999)


def test_partitioned_insert_reads_touched_partitions(spark, tmp_path):
    from pyspark.sql.types import StructType

    t = ParquetTable(spark, str(tmp_path / "p"), StructType.fromDDL(ROW), ["n"])
    assert insert_new(t, literal_table(spark, [("a", 1, "x"), ("a", 2, "x")], ROW), ["k", "n"], prune=["n"]).inserted == 2
    assert insert_new(t, literal_table(spark, [("a", 1, "y"), ("b", 1, "y")], ROW), ["k", "n"], prune=["n"]).inserted == 1
    assert content(t) == [("a", 1, "x"), ("a", 2, "x"), ("b", 1, "y")]


def test_failed_batch_counts_as_skipped(spark, tmp_path):
    t = table(spark, tmp_path)
    insert_new(t, literal_table(spark, [("a", 1, "x")], ROW), ["k"])
    broken = spark.range(2).select(F.col("id").cast("string").alias("k"), F.concat(F.lit("x"), "id").alias("v")).withColumn(
        "n", F.col("v").cast("int")
    )
    stats = insert_guarded(t, broken, ["k"])
    assert (stats.inserted, stats.skipped) == (0, 2) and stats.error
    assert content(t) == [("a", 1, "x")]


def test_upsert_replace_patch_snapshot(spark, tmp_path):
    t = table(spark, tmp_path)
    t.replace(literal_table(spark, [("a", 1, "x"), ("b", 2, "y")], ROW))
    before = t.read()
    upsert(t, literal_table(spark, [("b", 3, "z"), ("b", 4, "w"), ("c", 1, "q")], ROW), ["k"], "n")
    assert content(t) == [("a", 1, "x"), ("b", 4, "w"), ("c", 1, "q")]
    assert before.count() == 2, "readers of the earlier version are undisturbed"
    replace_where(t, F.col("v") == "x", literal_table(spark, [("d", 9, "x")], ROW))
    assert content(t) == [("b", 4, "w"), ("c", 1, "q"), ("d", 9, "x")]
    patch(t, literal_table(spark, [("b", None, "new"), ("c", 7, None)], ROW), ["k"], ["n", "v"])
    assert content(t) == [("b", 4, "new"), ("c", 7, "q"), ("d", 9, "x")]
    version = t.version()
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        refresh_snapshot(t, literal_table(spark, [("e", 1, "no")], ROW).withColumn("n", F.col("v").cast("int")))
    assert t.version() == version and len(content(t)) == 3, "a failed refresh leaves the snapshot as it was"


def test_backfill_and_mark(spark):
    facts = literal_table(spark, [(1, "EUR", None), (2, "EUR/shares", None), (3, "USD", None), (4, "GBP", "CHF"), (5, "XAU", None)],
                          "id int, unit string, currency string")
    assert {r.id: r.currency for r in backfill_currency(facts).collect()} == {1: "EUR", 2: None, 3: None, 4: "CHF", 5: None}
    docs = literal_table(spark, [("a", False), ("b", True), ("c", False)], "k string, done boolean")
    assert {r.k: r.done for r in mark(docs, docs.where("k = 'a'"), "k", "done").collect()} == {"a": True, "b": True, "c": False}


def test_packaged_tables(spark):
    mapping = constants.table(spark, "tag_mapping")
    assert mapping.count() == 118
    assert mapping.groupBy("namespace", "concept").count().where("count > 1").count() == 0
    assert len(constants.currency_codes()) == 66
    assert constants.table(spark, "exchanges").count() == 9
    assert len(TABLES) == 17


def test_runs(spark, tmp_path):
    t = ParquetTable(spark, str(tmp_path / "runs"), schema("import_runs"))
    runs.start_run(t, "r1", "1", "facts", "2024-01-01 00:00:00", "c1")
    runs.start_run(t, "r2", "1", "facts", "2024-01-01 06:00:00", "c1")
    runs.start_run(t, "r3", "1", "prices", "2024-01-01 11:00:00")
    runs.finish_run(t, "r1", WriteStats(processed=5, inserted=3, skipped=2), "2024-01-01 00:01:30")
    runs.close_in_table(t, "2024-01-01 12:30:00", max_age_hours=6)
    state = {r.id: r for r in runs.runs_state(t.read()).collect()}
    assert (state["r1"].status, state["r1"].records_inserted, state["r1"].duration_seconds) == ("success", 3, 90)
    assert (state["r2"].status, state["r2"].errors["age_hours"], state["r2"].errors["previous_status"]) == ("failed", "6.50", "running")
    assert state["r3"].status == "running"
    assert runs.latest_run(runs.runs_state(t.read())).first().id == "r2"


def facts_document(cik, accn, val, filed="2024-02-01"):
    item = {"start": "2023-01-01", "end": "2023-12-31", "val": val, "accn": accn, "fy": 2023, "fp": "FY", "form": "10-K", "filed": filed}
    return json.dumps({"cik": cik, "entityName": "A", "facts": {"us-gaap": {"Revenues": {"units": {"EUR": [item]}}}}})


def submissions_document(cik, accn):
    recent = {"accessionNumber": [accn], "filingDate": ["2024-02-01"], "reportDate": ["2023-12-31"], "form": ["10-K"],
              "primaryDocument": ["d.htm"]}
    return json.dumps({"cik": cik, "filings": {"recent": recent}})


def universe(spark, *rows):
    return documents.parse_universe(spark.createDataFrame([(json.dumps({"data": rows}),)], "value string"))


def test_sync_twice_adds_nothing(spark, tmp_path):
    catalog = Catalog(spark, str(tmp_path / "db"))
    companies = universe(spark, ["1", "One", "one", "NYSE"], ["2", "Two", "two", "nasdaq"], ["3", "Three", "", ""])
    filings = documents.parse_submissions(spark.createDataFrame([(submissions_document("1", "0-1"),)], "value string"))
    texts = [facts_document(1, "0-1", 10), facts_document(2, "0-2", 20), facts_document(9, "0-9", 30), facts_document(2, "0-3", "n/a")]
    values = documents.parse_company_facts(spark.createDataFrame([(x,) for x in texts], "value string"))
    first = ingest.sync(catalog, companies, filings, values, "1", "2024-03-01")
    assert first["companies"].inserted == 3 and first["listings"].inserted == 2 and first["identifiers"].inserted == 5
    assert (first["filings"].inserted, first["facts"].inserted) == (1, 2)
    renamed = universe(spark, ["1", "One Inc", "one", "NYSE"], ["2", "Two", "two", "nasdaq"], ["3", "Three", "", ""])
    again = ingest.sync(catalog, renamed, filings, values, "1", "2024-03-02")
    assert all(again[k].inserted == 0 for k in ("companies", "listings", "identifiers", "filings", "facts", "exchanges"))
    assert again["updated"].updated == 3
    assert sorted(r.legal_name for r in catalog.table("companies").collect()) == ["One Inc", "Three", "Two"]
    facts = catalog.table("financial_facts")
    assert sorted((r.value, r.filing_id is not None) for r in facts.collect()) == [(Decimal(10), True), (Decimal(20), False)]

    # The missing filing arrives; its facts are linked and nothing is doubled.
    late = documents.parse_submissions(spark.createDataFrame([(submissions_document("2", "0-2"),)], "value string"))
    ingest.ingest_filings(catalog, late, "1")
    catalog.store("financial_facts").replace(landing.relink_filings(facts, catalog.table("filings")))
    assert catalog.table("financial_facts").where("filing_id IS NULL").count() == 0
    assert catalog.table("financial_facts").count() == 2

    per_eur = literal_table(spark, [("USD", DAY(2023, 12, 29), 1.25), ("GBP", DAY(2023, 12, 29), 0.0)],
                            "currency string, rate_date date, per_eur double")
    pairs = literal_table(spark, [("AED", DAY(2023, 12, 29), 0.25), ("EUR", DAY(2023, 12, 29), 9.0)],
                          "currency string, rate_date date, usd_per_unit double")
    assert ingest.load_fx_rates(catalog, per_eur, pairs) == 2
    assert ingest.load_fx_rates(catalog, per_eur, pairs) == 2
    core = core_financials(catalog.table("financial_facts"), catalog.table("fx_rates"))
    assert sorted((r.revenue, r.revenue_usd) for r in core.collect()) == [(10, Decimal("12.5")), (20, Decimal("25"))]


def test_unknown_currency_is_refused(spark, tmp_path):
    with pytest.raises(ValueError, match="XAU"):
        ingest.load_fx_rates(Catalog(spark, str(tmp_path)), literal_table(
            spark, [("USD", DAY(2024, 1, 1), 1.0)], "currency string, rate_date date, per_eur double"), currencies=["XAU"])


def test_membership_reload(spark, tmp_path):
    t = ParquetTable(spark, str(tmp_path / "m"), schema("index_constituents"))
    listings = literal_table(spark, [("one", "c1", True, False, None), ("ONE", "c2", True, True, DAY(2020, 1, 1)), ("two", "c3", False, True, None)],
                             "ticker string, company_id string, is_active boolean, is_primary boolean, listing_date date")
    spans = "ticker string, start_date date, end_date date"
    parsed = literal_table(spark, [("ONE", DAY(2020, 1, 1), None), ("GONE", DAY(2019, 1, 1), DAY(2020, 6, 1))], spans)
    history.load_membership(t, parsed, listings, "feed", "2024-01-01")
    stats = history.load_membership(t, parsed.where("ticker = 'ONE'"), listings, "feed", "2024-01-02").first()
    assert (stats.rows, stats.resolved, stats.unresolved, stats.last_date) == (1, 1, 0, DAY(2020, 1, 1))
    assert [(r.ticker, r.company_id) for r in t.read().collect()] == [("ONE", "c2")]


def test_landing_takes_each_file_once(spark, tmp_path):
    inbox = tmp_path / "in"
    inbox.mkdir()
    (inbox / "a.json").write_text(submissions_document("1", "0-1"))
    identifiers = literal_table(spark, [("c1", "CIK", "0000000001")], "company_id string, identifier_type string, identifier_value string")
    path, seen = str(tmp_path / "filings"), []

    def parse(batch):
        numbers = batch.sparkSession.createDataFrame(identifiers.toArrow())
        return ingest.filing_rows(documents.parse_submissions(batch), numbers, "1")

    sink = landing.insert_sink(
        ParquetTable(spark, path, schema("filings")), NATURAL_KEYS["filings"], parse, record=lambda i, s: seen.append((s.processed, s.inserted)),
    )

    def run():
        landing.land_incremental(spark, str(inbox), sink, "t", checkpoint=str(tmp_path / "cp"))

    run()
    run()
    (inbox / "b.json").write_text(submissions_document("1", "0-2"))
    (inbox / "c.json").write_text(submissions_document("1", "0-1"))
    run()
    assert [s for s in seen if s[0]] == [(1, 1), (2, 1)]
    assert ParquetTable(spark, path, schema("filings")).read().count() == 2


def test_registry_keeps_earlier_contents(spark):
    old = literal_table(spark, [("a", "1"), ("b", "1")], "source_identifier string, checksum string")
    new = literal_table(spark, [("a", "1"), ("b", "2"), ("c", "1")], "source_identifier string, checksum string")
    assert sorted(tuple(r) for r in landing.changed_documents(new, old).collect()) == [("b", "2"), ("c", "1")]
    assert landing.registry_with(old, new).count() == 4


def test_refresh_after_a_failed_load_changes_nothing(spark, tmp_path):
    t = table(spark, tmp_path)
    build = lambda: literal_table(spark, [("a", 1, "x")], ROW)
    landing.refresh_after(lambda: None, t, build)

    def fails():
        raise RuntimeError("load failed")

    with pytest.raises(RuntimeError):
        landing.refresh_after(fails, t, build)
    assert t.version() == 1


def test_an_append_that_dies_leaves_the_rows_as_they_were(spark, tmp_path):
    t = table(spark, tmp_path)
    insert_new(t, literal_table(spark, [("a", 1, "x")], ROW), ["k"])
    # Part files of a write that never committed.
    folder = tmp_path / "t" / "v=1" / "segment=2"
    literal_table(spark, [("b", 1, "y")], ROW).write.parquet(str(folder))
    (folder / "_SUCCESS").unlink()
    assert content(t) == [("a", 1, "x")]
    insert_new(t, literal_table(spark, [("c", 1, "z")], ROW), ["k"])
    assert content(t) == [("a", 1, "x"), ("c", 1, "z")] and [s[-1] for s in t.segments()] == ["1", "3"]


def test_a_second_writer_is_refused(spark, tmp_path):
    t = table(spark, tmp_path)
    t.replace(literal_table(spark, [("a", 1, "x")], ROW))
    (tmp_path / "t" / "v=2").mkdir()
    (tmp_path / "t" / "v=2" / "segment=1.claim").touch()
    with pytest.raises(Exception, match="exist"):
        t._claim("v=2/segment=1")
    assert t.version() == 1
    t.replace(literal_table(spark, [("b", 1, "x")], ROW))
    assert t.version() == 3 and content(t) == [("b", 1, "x")]


def test_pruning_needs_partition_columns(spark, tmp_path):
    with pytest.raises(ValueError, match="partition"):
        insert_new(table(spark, tmp_path), literal_table(spark, [("a", 1, "x")], ROW), ["k"], prune=["n"])


def test_landing_reads_a_file_and_a_folder_alike(spark, tmp_path):
    rows = spark.range(30).select(F.col("id").cast("string").alias("k"), F.col("id").cast("int").alias("n"), F.lit("v").alias("v"))
    rows.repartition(3).write.parquet(str(tmp_path / "many.parquet"))
    rows.coalesce(1).write.parquet(str(tmp_path / "one"))
    next((tmp_path / "one").glob("part-*.parquet")).rename(tmp_path / "one.parquet")
    for name in ("many", "one"):
        t = table(spark, tmp_path, name=f"landed-{name}")
        for _ in range(2):
            landing.land_incremental(spark, str(tmp_path / f"{name}.parquet"), landing.insert_sink(t, ["k"], lambda b: b), name,
                                     "parquet", rows.schema, str(tmp_path / f"cp-{name}"))
        assert t.read().count() == 30


def test_failed_sync_closes_its_run(spark, tmp_path):
    catalog = Catalog(spark, str(tmp_path / "db"))
    companies = universe(spark, ["1", "One", "one", "NYSE"])
    broken = companies.withColumn("name", F.raise_error(F.lit("broken universe")).cast("string"))
    nothing = documents.parse_submissions(spark.createDataFrame([], "value string"))
    values = documents.parse_company_facts(spark.createDataFrame([], "value string"))
    with pytest.raises(Exception, match="broken universe"):
        ingest.sync(catalog, broken, nothing, values, "1", "2024-03-01")
    run = runs.runs_state(catalog.table("import_runs")).first()
    assert run.status == "failed" and "broken universe" in run.errors["error"]


class Interrupted(ParquetTable):
    """A table whose writer is overtaken by another one just before it commits."""

    def overtaken_by(self, *others):
        self.others = list(others)
        return self

    def _commit(self, folder, state, tag=None):
        if self.others:
            self.others.pop(0)()
        return super()._commit(folder, state, tag)


def interrupted(t, *others):
    return Interrupted(t.spark, t.path, t.schema, t.partition_by).overtaken_by(*others)


@pytest.mark.parametrize("first", [False, True])
@pytest.mark.parametrize("parts", [[], ["n"]])
def test_overlapping_inserts_store_a_key_once(spark, tmp_path, first, parts):
    t = table(spark, tmp_path)
    t.partition_by = parts
    prune = {"prune": parts} if parts else {}
    if not first:
        insert_new(t, literal_table(spark, [("z", 1, "z")], ROW), ["k", "n"])
    ours = literal_table(spark, [("a", 1, "ours"), ("b", 1, "ours"), (None, None, "ours")], ROW)
    theirs = literal_table(spark, [("b", 1, "theirs"), ("c", 2, "theirs"), (None, None, "theirs")], ROW)
    more = literal_table(spark, [("a", 1, "more"), ("d", 1, "more")], ROW)
    late = interrupted(t, lambda: insert_new(t, theirs, ["k", "n"]), lambda: insert_new(t, more, ["k", "n"]))
    stats = insert_new(late, ours, ["k", "n"], **prune)
    assert (stats.processed, stats.inserted, stats.skipped) == (3, 0, 3)
    rows = {(r.k, r.n): r.v for r in t.read().collect()}
    assert rows == {("a", 1): "more", ("b", 1): "theirs", ("c", 2): "theirs", ("d", 1): "more", (None, None): "theirs"} | (
        {} if first else {("z", 1): "z"})
    assert t.read().count() == len(rows)


def test_an_insert_begun_before_a_replacement_starts_over(spark, tmp_path):
    t = table(spark, tmp_path)
    t.replace(literal_table(spark, [("a", 1, "old")], ROW))
    batch = literal_table(spark, [("a", 9, "new"), ("b", 9, "new")], ROW)
    late = interrupted(t, lambda: t.replace(literal_table(spark, [("b", 1, "old")], ROW)))
    assert insert_new(late, batch, ["k"]).inserted == 1
    assert content(t) == [("a", 9, "new"), ("b", 1, "old")]


def test_overlapping_upserts_and_patches_lose_nothing(spark, tmp_path):
    t = table(spark, tmp_path)
    t.replace(literal_table(spark, [("a", 1, "x"), ("b", 1, "y")], ROW))
    other = lambda: upsert(t, literal_table(spark, [("a", 2, "theirs")], ROW), ["k"], "n")
    upsert(interrupted(t, other), literal_table(spark, [("b", 2, "ours")], ROW), ["k"], "n")
    assert content(t) == [("a", 2, "theirs"), ("b", 2, "ours")]
    other = lambda: patch(t, literal_table(spark, [("a", None, "patched")], ROW), ["k"], ["n", "v"])
    patch(interrupted(t, other), literal_table(spark, [("a", 7, None), ("b", None, "too")], ROW), ["k"], ["n", "v"])
    assert content(t) == [("a", 7, "patched"), ("b", 2, "too")]
    # What was computed from rows that are no longer current is refused.
    state, rows = t.state(), t.read()
    t.append(literal_table(spark, [("c", 1, "z")], ROW))
    with pytest.raises(Overlap):
        t.replace(rows, state)
    assert t.read().count() == 3


def test_the_later_of_two_full_reloads_stays(spark, tmp_path):
    t = table(spark, tmp_path)
    t.replace(literal_table(spark, [("a", 1, "x")], ROW))
    late = interrupted(t, lambda: t.replace(literal_table(spark, [("b", 1, "first")], ROW)))
    late.replace(literal_table(spark, [("c", 1, "last")], ROW))
    assert content(t) == [("c", 1, "last")]


def test_writers_in_parallel(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    t = table(spark, tmp_path)

    def load(i):
        own = ParquetTable(spark, t.path, t.schema)
        return insert_new(own, spark.range(i * 10, i * 10 + 30).selectExpr("CAST(id AS STRING) AS k", "1 AS n", f"'{i}' AS v"), ["k"])

    with ThreadPoolExecutor(4) as pool:
        stats = list(pool.map(load, range(4)))
    assert sum(s.inserted for s in stats) == 60 and all(s.processed == 30 for s in stats)
    assert t.read().count() == t.read().select("k").distinct().count() == 60


def test_a_decided_write_is_finished_by_the_next_writer(spark, tmp_path):
    t = table(spark, tmp_path)
    insert_new(t, literal_table(spark, [("a", 1, "x")], ROW), ["k"])
    insert_new(t, literal_table(spark, [("b", 1, "x")], ROW), ["k"])
    # The writer died after it had taken its turn and before it marked its rows.
    (tmp_path / "t" / "v=1" / "segment=2" / "_SUCCESS").unlink()
    assert t.read().count() == 1
    assert insert_new(t, literal_table(spark, [("b", 1, "y"), ("c", 1, "y")], ROW), ["k"]).inserted == 1
    assert content(t) == [("a", 1, "x"), ("b", 1, "x"), ("c", 1, "y")]


def test_a_named_batch_is_stored_once_and_reads_nothing_again(spark, tmp_path):
    t = table(spark, tmp_path)
    seen = []
    sink = landing.insert_sink(t, ["k"], lambda b: (seen.append(1), b)[1], record=lambda i, s: seen.append((i, s.inserted)), feed="feed")
    batch = literal_table(spark, [("a", 1, "x")], ROW)
    sink(batch, 0)
    sink(batch.withColumn("k", F.raise_error(F.lit("read again")).cast("string")), 0)
    assert seen == [1, (0, 1)] and t.state().turn == 0 and t.version() == 1
    assert insert_new(t, batch, ["k"], tag="feed-0") == WriteStats()
    # The name outlives the version that the batch was stored in.
    t.replace(literal_table(spark, [("z", 1, "x")], ROW))
    sink(batch, 0)
    assert content(t) == [("z", 1, "x")]
    sink(batch, 1)
    assert t.read().count() == 2


def files(t):
    return {f: open(f, "rb").read() for f in t.read().inputFiles() for f in [f.removeprefix("file://")]}


def test_relinking_and_backfill_leave_other_years_alone(spark, tmp_path):
    facts = ParquetTable(spark, str(tmp_path / "facts"), schema("financial_facts"), ["fiscal_year"])
    rows = [(str(i), "c1", None, f"{i}|g:A|{2000 + i % 4}", "A", Decimal(i), "EUR" if i % 4 == 1 else "USD", 2000 + i % 4,
             None, DAY(2000 + i % 4, 12, 31)) for i in range(12)]
    ddl = ("id string, company_id string, filing_id string, source_id string, concept string, value decimal(30,10), unit string, "
           "fiscal_year int, period_start date, period_end date")
    half = literal_table(spark, rows[:6], ddl)
    insert_new(facts, half, NATURAL_KEYS["financial_facts"], prune=["fiscal_year"])
    insert_new(facts, literal_table(spark, rows, ddl), NATURAL_KEYS["financial_facts"], prune=["fiscal_year"])
    before = files(facts)
    filings = literal_table(spark, [("f2", "c1", "2"), ("f6", "c1", "6")], "id string, company_id string, accession_number string")
    assert landing.relink_table(facts, filings) == 3, "the year 2002 alone"
    after = files(facts)
    assert {f for f in before if "fiscal_year=2002" not in f} == {f for f in after if "fiscal_year=2002" not in f}
    assert not {f for f in before if "fiscal_year=2002" in f} & set(after)
    assert {r.id: r.filing_id for r in facts.read().where("filing_id IS NOT NULL").collect()} == {"2": "f2", "6": "f6"}
    assert landing.relink_table(facts, filings) == 0 and facts.version() == 2
    assert backfill_table(facts) == 3 and facts.version() == 3
    assert {r.currency for r in facts.read().where("fiscal_year = 2001").collect()} == {"EUR"}
    assert files(facts).keys() & before.keys() == {f for f in before if "fiscal_year=2000" in f or "fiscal_year=2003" in f}
    assert facts.read().count() == 12
    # Rows come and go as in any other version.
    extra = literal_table(spark, [("x", *rows[3][1:3], "x", "B", *rows[3][5:])], ddl)
    assert insert_new(facts, extra, NATURAL_KEYS["financial_facts"], prune=["fiscal_year"]).inserted == 1
    assert insert_new(facts, literal_table(spark, rows[:1], ddl), NATURAL_KEYS["financial_facts"], prune=["fiscal_year"]).inserted == 0
    facts.replace(facts.read().where("fiscal_year = 2003"))
    assert facts.read().count() == 4


def scan(spark, *rows):
    return literal_table(spark, [(i, f"{i}.json", c, "application/json") for i, c in rows],
                         "source_identifier string, storage_path string, checksum string, content_type string")


def delivery(spark):
    companies = universe(spark, ["1", "One", "one", "NYSE"], ["2", "Two", "two", "nasdaq"])
    filings = documents.parse_submissions(spark.createDataFrame([(submissions_document("1", "0-1"),), (submissions_document("9", "0-9"),)], "value string"))
    texts = [facts_document(1, "0-1", 10), facts_document(1, "0-1", None), facts_document(2, "0-2", "n/a"), facts_document(9, "0-9", 30)]
    values = documents.parse_company_facts(spark.createDataFrame([(x,) for x in texts], "value string"))
    names = ["submissions:0000000001", "submissions:0000000009", "facts:0000000001", "facts:0000000002", "facts:0000000009", "universe:all"]
    return companies, filings, values, scan(spark, *[(n, "sum") for n in names])


def flagged(catalog):
    return {(r.source_identifier, r.checksum) for r in catalog.table("raw_documents").where("is_processed").collect()}


def test_sync_counts_rejects_and_flags_what_it_accounts_for(spark, tmp_path):
    catalog = Catalog(spark, str(tmp_path / "db"))
    companies, filings, values, raw = delivery(spark)
    # Registered earlier and not part of this delivery; the one name has another content by now.
    foreign = scan(spark, ("facts:0000000007", "sum"), ("facts:0000000001", "old"))
    ingest.register_documents(catalog, foreign, "1", "2024-01-01")
    stats = ingest.sync(catalog, companies, filings, values, "1", "2024-03-01", raw=raw)
    assert stats["facts"] == WriteStats(processed=2, inserted=1, skipped=1)
    run = runs.runs_state(catalog.table("import_runs")).first()
    assert run.status == "success" and run.records_skipped == 1
    rejects = catalog.table("fact_rejects").collect()
    assert [(r.cik, r.concept, r.errors, r.run_id) for r in rejects] == [("0000000001", "Revenues", "value is required", run.id)]
    found = {(r.source_identifier, r.step): (r.records_read, r.records_stored, r.records_rejected, r.records_left_out, r.records_waiting)
             for r in catalog.table("document_outcomes").collect()}
    assert found == {
        ("submissions:0000000001", "filings"): (1, 1, 0, 0, 0), ("submissions:0000000009", "filings"): (1, 0, 0, 0, 1),
        ("facts:0000000001", "facts"): (2, 1, 1, 0, 0), ("facts:0000000002", "facts"): (1, 0, 0, 1, 0),
        ("facts:0000000009", "facts"): (1, 0, 0, 0, 1)}
    assert flagged(catalog) == {(n, "sum") for n in ("submissions:0000000001", "facts:0000000001", "facts:0000000002", "universe:all")}
    # The unknown company arrives; a repeated delivery completes it and adds no second reject.
    more = universe(spark, ["9", "Nine", "nine", "NYSE"])
    again = ingest.sync(catalog, companies.unionByName(more), filings, values, "1", "2024-03-02", raw=raw)
    assert again["facts"].inserted == 1 and catalog.table("fact_rejects").count() == 1
    assert len(flagged(catalog)) == 6


def test_facts_wait_when_filings_fail(spark, tmp_path):
    catalog = Catalog(spark, str(tmp_path / "db"))
    companies, filings, values, raw = delivery(spark)
    real = catalog.store

    class Broken(ParquetTable):
        def append(self, *args, **options):
            raise RuntimeError("disk is full")

    catalog.store = lambda name: (Broken if name == "filings" else ParquetTable)(
        spark, real(name).path, schema(name), real(name).partition_by, real(name).sort_by)
    stats = ingest.sync(catalog, companies, filings, values, "1", "2024-03-01", raw=raw)
    assert "disk is full" in stats["filings"].error and stats["facts"] == WriteStats(error="facts wait for the filings")
    assert catalog.table("financial_facts").count() == 0 and flagged(catalog) == set()
    run = runs.runs_state(catalog.table("import_runs")).first()
    assert run.status == "partial" and "disk is full" in run.errors["error"]
    assert catalog.table("companies").where("last_synced_at IS NOT NULL").count() == 0
    noted = {r.source_identifier: (r.records_stored, r.error is not None) for r in catalog.table("document_outcomes").collect()}
    assert noted == {"submissions:0000000001": (0, True), "submissions:0000000009": (0, True)}
    catalog.store = real
    again = ingest.sync(catalog, companies, filings, values, "1", "2024-03-02", raw=raw)
    assert again["facts"].inserted == 1 and catalog.table("financial_facts").where("filing_id IS NULL").count() == 0


def test_failed_facts_leave_their_documents_open(spark, tmp_path, monkeypatch):
    catalog = Catalog(spark, str(tmp_path / "db"))
    companies, filings, values, raw = delivery(spark)
    real = ingest.insert_guarded
    monkeypatch.setattr(ingest, "insert_guarded", lambda t, batch, keys, **o: WriteStats(processed=1, skipped=1, error="lost")
                        if t.path.endswith("financial_facts") else real(t, batch, keys, **o))
    ingest.sync(catalog, companies, filings, values, "1", "2024-03-01", raw=raw)
    # Of the facts only the document without anything to store is done; one that gave no rows stays open.
    assert flagged(catalog) == {("submissions:0000000001", "sum"), ("facts:0000000002", "sum")}


# --- refresh of what changed ------------------------------------------------------


def stored_core(spark, tmp_path):
    from periodica.workload.views import Views

    v = Views(spark, "/root/testdata/sf0.001")
    facts = ParquetTable(spark, str(tmp_path / "facts"), v["financial_facts"].schema, ["fiscal_year"], ["company_id"])
    rates = ParquetTable(spark, str(tmp_path / "rates"), v["fx_rates"].schema)
    return v, facts, rates, refresh.core_table(facts, rates, str(tmp_path / "core"))


def equals_full_build(core, facts, rates):
    want = core_financials(facts.read(), rates.read()).select(*core.schema.names)
    got = core.read()
    assert got.count() == want.count() > 0
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_refresh_of_changed_keys_equals_a_full_build(spark, tmp_path):
    v, facts, rates, core = stored_core(spark, tmp_path)
    rates.append(v["fx_rates"])
    source = v["financial_facts"]
    facts.append(source.where("company_id % 2 = 0 OR fiscal_year < 1995"))
    assert refresh.refresh_core_table(core, facts, rates) > 0
    equals_full_build(core, facts, rates)
    assert refresh.refresh_core_table(core, facts, rates) == 0 and core.version() == 1, "nothing changed, nothing is written"

    # A load of two years: rows of all others stay where they are.
    before, years = core.partitions(), (1996, 1997)
    facts.append(source.where("company_id % 2 = 1 AND fiscal_year IN (1996, 1997)"))
    refresh.refresh_core_table(core, facts, rates)
    equals_full_build(core, facts, rates)
    after = core.partitions()
    moved = {f.rsplit("=", 1)[1] for f in set(before) ^ set(after)}
    assert moved == {str(y) for y in years} and len(set(before) & set(after)) == len(before) - len(years)
    # Repeated and irrelevant facts change no result.
    facts.append(source.where("fiscal_period = 'FY' AND fiscal_year = 1993").limit(5))
    facts.append(source.where("fiscal_year = 1994").withColumn("fiscal_period", F.lit("Q1")))
    refresh.refresh_core_table(core, facts, rates)
    equals_full_build(core, facts, rates)


def test_refresh_follows_rewritten_facts_and_new_rates(spark, tmp_path):
    from periodica.operators.writes import change_partitions

    v, facts, rates, core = stored_core(spark, tmp_path)
    early = F.col("rate_date") < "1996-01-01"
    rates.append(v["fx_rates"].where(early))
    facts.append(v["financial_facts"])
    refresh.refresh_core_table(core, facts, rates)
    # One year is rewritten with rows changed and rows gone; then facts of a company go entirely.
    change_partitions(
        facts, lambda rows: rows.where("fiscal_year = 1996"),
        lambda rows: rows.where("company_id % 5 <> 0").withColumn("value", (F.col("value") * 2).cast("decimal(30,10)")))
    refresh.refresh_core_table(core, facts, rates)
    equals_full_build(core, facts, rates)
    kept = {f for f in core.partitions() if "fiscal_year=1994" in f}
    rates.append(v["fx_rates"].where(~early))
    refresh.refresh_core_table(core, facts, rates)
    equals_full_build(core, facts, rates)
    assert kept <= set(core.partitions()), "new rates leave earlier years alone"
    facts.replace(facts.read().where("company_id % 3 <> 0"))
    refresh.refresh_core_table(core, facts, rates)
    equals_full_build(core, facts, rates)


def test_refresh_builds_anew_when_it_must(spark, tmp_path, monkeypatch):
    import shutil

    v, facts, rates, core = stored_core(spark, tmp_path)
    rates.append(v["fx_rates"])
    facts.append(v["financial_facts"])
    seen, some = [], refresh._refresh_some
    monkeypatch.setattr(refresh, "_refresh_some", lambda *args: seen.append(1) or some(*args))
    refresh.refresh_core_table(core, facts, rates)
    # Another way of building.
    refresh.refresh_core_table(core, facts, rates, component_versions="all")
    assert core.version() == 2 and not seen
    refresh.refresh_core_table(core, facts, rates)
    # Facts of an earlier version that were removed cannot be compared.
    facts.replace(facts.read().where("company_id % 4 <> 0"))
    shutil.rmtree(tmp_path / "facts" / "v=1")
    refresh.refresh_core_table(core, facts, rates)
    assert not seen
    equals_full_build(core, facts, rates)
    # A failed build leaves the table as it was.
    facts.append(v["financial_facts"].where("fiscal_year = 1996"))
    monkeypatch.setattr(refresh, "core_financials", lambda *a, **k: core_financials(*a, **k).withColumn(
        "revenue", F.raise_error(F.lit("broken")).cast("decimal(30,10)")))
    version = core.version()
    with pytest.raises(Exception, match="broken"):
        refresh.refresh_core_table(core, facts, rates)
    assert core.version() == version and seen == [1]


def test_refresh_reads_the_touched_years_only(spark, tmp_path, monkeypatch):
    v, facts, rates, core = stored_core(spark, tmp_path)
    rates.append(v["fx_rates"])
    facts.append(v["financial_facts"].where("fiscal_year < 1997"))
    refresh.refresh_core_table(core, facts, rates)
    facts.append(v["financial_facts"].where("fiscal_year = 1997"))
    plans, keep = [], ParquetTable.replace_partitions

    def spy(self, df, *rest):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return keep(self, df, *rest)

    monkeypatch.setattr(ParquetTable, "replace_partitions", spy)
    refresh.refresh_core_table(core, facts, rates)
    scans = [line for line in plans[0].split("\n") if "FileScan" in line and ("concept#" in line or "revenue#" in line)]
    # What is stored, the facts of the touched year, and the keys of the new segment, which holds no other year.
    narrow = [line for line in scans if re.search(r"PartitionFilters: \[[^]]*fiscal_year#\d+ (=|IN) [^]]*1997", line)]
    assert len(narrow) >= 2 and len(scans) - len(narrow) <= 2, scans


def test_refresh_with_an_overlapping_refresh(spark, tmp_path, monkeypatch):
    v, facts, rates, core = stored_core(spark, tmp_path)
    rates.append(v["fx_rates"])
    facts.append(v["financial_facts"].where("fiscal_year < 1997"))
    refresh.refresh_core_table(core, facts, rates)
    facts.append(v["financial_facts"].where("fiscal_year = 1997"))
    late, some = [v["financial_facts"].where("fiscal_year = 1998")], refresh._refresh_some

    def overtaken(*args):
        if late:
            facts.append(late.pop())
            refresh.refresh_core_table(core, facts, rates)
        return some(*args)

    monkeypatch.setattr(refresh, "_refresh_some", overtaken)
    refresh.refresh_core_table(core, facts, rates)
    equals_full_build(core, facts, rates)
