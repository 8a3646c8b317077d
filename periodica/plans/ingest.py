"""Landed frames to stored tables: universe, filings, facts, prices, currency rates.

Every load covers all companies of its input in one job and is a chain of
expressions followed by an insert-if-absent, so running it again adds nothing.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from periodica import constants
from periodica.functions import facts as rules
from periodica.functions import keys
from periodica.operators.joins import absent_keys
from periodica.operators.windows import latest_by, preferred
from periodica.operators.writes import (
    CODEC, WriteStats, change, insert_guarded, insert_new, mark, patch, patch_rows, rounds, rows_by_partition, upsert,
)
from periodica.plans import runs
from periodica.plans.core import core_financials
from periodica.schemas import NATURAL_KEYS, schema
from periodica.session import forget, releasing, scratch_dir
from periodica.sources.tables import Catalog


def written(df: DataFrame, path: str, by: Sequence[str] = (), near: Sequence[str] = ()) -> DataFrame:
    """Rows added to a folder of the shared one, and what is in it.

    With ``by`` they lie in a folder for each of its values, sorted by ``near`` in each file.
    """
    if by:
        df = df.sortWithinPartitions(*by, *near)
    with releasing(df.sparkSession):
        df.write.mode("append").option("compression", CODEC).partitionBy(*by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)


def written_once(df: DataFrame, name: str, below: str | None = None) -> DataFrame:
    """Rows stored in the shared folder and read back, so that several writes take them from one evaluation.

    ``below`` is a folder that the caller removes when it has done with them.
    """
    return written(df, f"{below or scratch_dir(df.sparkSession)}/{name}-{uuid4().hex}")


# --- universe -----------------------------------------------------------------


def map_exchange(df: DataFrame, label: str = "exchange") -> DataFrame:
    """Rows with the exchange behind their label; unknown labels get NULLs."""
    known = constants.table(df.sparkSession, "exchanges").select(
        keys.exchange_key(F.col("label")).alias("_label"),
        F.col("code").alias("exchange_code"), F.col("name").alias("exchange_name"), "mic",
    )
    return df.withColumn("_label", keys.exchange_key(F.col(label))).join(known, "_label", "left").drop("_label")


def parse_companies(universe: DataFrame) -> DataFrame:
    """Universe rows with normalized number, name, country and ticker."""
    return universe.select(
        keys.cik(F.col("cik")).alias("cik"),
        F.trim("name").alias("legal_name"),
        keys.country(F.col("exchange")).alias("country"),
        F.lit("USD").alias("currency"),
        F.nullif(F.upper("ticker"), F.lit("")).alias("ticker"),
        F.nullif(F.trim("exchange"), F.lit("")).alias("exchange"),
    )


def explode_identifiers(parsed: DataFrame) -> DataFrame:
    """CIK (primary) and TICKER identifiers of parsed companies."""
    pairs = F.array(
        F.struct(F.lit("CIK").alias("identifier_type"), F.col("cik").alias("identifier_value"),
                 F.lit(True).alias("is_primary")),
        F.struct(F.lit("TICKER").alias("identifier_type"), F.col("ticker").alias("identifier_value"),
                 F.lit(False).alias("is_primary")),
    )
    return (
        parsed.select("company_id", F.explode(pairs).alias("i"))
        .select("company_id", "i.*")
        .where("identifier_value IS NOT NULL")
        .distinct()
    )


def with_company_ids(parsed: DataFrame, identifiers: DataFrame) -> DataFrame:
    """Parsed companies with their stored id, or the id a new one will get."""
    stored = identifiers.where("identifier_type = 'CIK'").groupBy(F.col("identifier_value").alias("cik")).agg(
        F.min("company_id").alias("_stored")
    )
    return parsed.join(stored, "cik", "left").select(
        *parsed.columns,
        F.coalesce("_stored", keys.row_id(F.lit("company"), "cik")).alias("company_id"),
        F.col("_stored").isNotNull().alias("is_known"),
    )


def ingest_universe(catalog: Catalog, universe: DataFrame, provider_id: str) -> dict[str, WriteStats]:
    """Insert new companies, patch known ones, add identifiers and listings."""
    scratch_dir(catalog.spark)
    # Four tables are written from these rows; they keep the ids found now.
    with releasing(catalog.spark):
        parsed = with_company_ids(parse_companies(universe), catalog.table("company_identifiers")).checkpoint()
    one_each = preferred(parsed, ["company_id"], [F.col("legal_name").asc_nulls_last(), "country"])
    details = ["legal_name", "country", "currency"]
    known = catalog.table("companies")
    stats = {}
    fresh = one_each.select(F.col("company_id").alias("id"), *details, F.lit(True).alias("is_active"))
    if catalog.store("companies").version():
        changes = one_each.where("is_known").select(F.col("company_id").alias("id"), *details)
        with releasing(catalog.spark):
            updated = changes.join(known.select("id"), "id", "left_semi").count()
        patch(catalog.store("companies"), changes, ["id"], details)
        stats["updated"] = WriteStats(processed=updated, updated=updated)
    stats["companies"] = insert_new(catalog.store("companies"), fresh, ["id"])

    listed = map_exchange(parsed.where("ticker IS NOT NULL AND exchange IS NOT NULL")).where("exchange_code IS NOT NULL")
    places = listed.select(
        F.col("exchange_code").alias("code"), F.col("exchange_name").alias("name"),
        F.lit("USA").alias("country"), F.lit("America/New_York").alias("timezone"),
        F.lit("USD").alias("currency"), F.lit(True).alias("is_active"),
        keys.row_id(F.lit("exchange"), "exchange_code").alias("id"),
    )
    stats["exchanges"] = insert_new(catalog.store("exchanges"), places, ["code"])
    exchange_ids = catalog.table("exchanges").select(
        F.col("id").alias("exchange_id"), F.col("code").alias("exchange_code")
    )
    stored = catalog.table("company_listings")
    open_key = ["company_id", "exchange_id", "ticker", "share_class"]
    # A ticker that was closed and is listed again is a new listing, so earlier ones count in its id.
    earlier = stored.groupBy("company_id", "exchange_id", "ticker").agg(F.count("*").alias("_earlier"))
    listings = listed.join(exchange_ids, "exchange_code").join(
        earlier, ["company_id", "exchange_id", "ticker"], "left"
    ).select(
        keys.row_id(F.lit("listing"), "company_id", "exchange_id", "ticker",
                    F.coalesce("_earlier", F.lit(0)).cast("string")).alias("id"),
        "company_id", "exchange_id", "ticker", F.lit(None).cast("string").alias("share_class"),
        F.lit(None).cast("date").alias("listing_date"), F.lit(True).alias("is_primary"), F.lit(True).alias("is_active"),
    )
    unlisted = absent_keys(listings, stored.where("delisting_date IS NULL"), open_key)
    stats["listings"] = insert_new(catalog.store("company_listings"), unlisted, ["id"])
    identifiers = explode_identifiers(parsed).select(
        keys.row_id(F.lit("identifier"), "company_id", "identifier_type", F.lit(provider_id), "identifier_value").alias("id"),
        "*", F.lit(provider_id).alias("provider_id"),
    )
    stats["identifiers"] = insert_new(
        catalog.store("company_identifiers"), identifiers, NATURAL_KEYS["company_identifiers"]
    )
    return stats


# --- filings ------------------------------------------------------------------


def financial_forms(filings: DataFrame) -> DataFrame:
    return filings.where(rules.is_financial_form(F.col("form")))


def company_ids(identifiers: DataFrame) -> DataFrame:
    return identifiers.where("identifier_type = 'CIK'").groupBy(F.col("identifier_value").alias("cik")).agg(
        F.min("company_id").alias("company_id")
    )


def _filing_columns(filings: DataFrame, provider_id: str) -> DataFrame:
    return filings.select(
        keys.row_id(F.lit("filing"), F.lit(provider_id), keys.accession(F.col("accession_number"))).alias("id"),
        "company_id", F.lit(provider_id).alias("provider_id"), "form",
        keys.accession(F.col("accession_number")).alias("accession_number"),
        "filing_date", F.lit(None).cast("date").alias("period_start"), "period_end",
        F.col("fiscal_year").cast("int").alias("fiscal_year"),
        rules.fiscal_period(F.col("fiscal_period")).alias("fiscal_period"),
        "filing_url", "is_amended", "cik",
    )


def filing_rows(submissions: DataFrame, identifiers: DataFrame, provider_id: str) -> DataFrame:
    """Financial filings of known companies, as stored."""
    return _filing_columns(financial_forms(submissions).join(company_ids(identifiers), "cik"), provider_id)


def _document(rows: DataFrame, kind: str) -> Column:
    """The document that a row comes from: the one it names, else that of its kind and company."""
    return F.col("source_identifier") if "source_identifier" in rows.columns else F.concat(F.lit(f"{kind}:"), "cik")


def stage_filings(catalog: Catalog, submissions: DataFrame, below: str | None = None) -> DataFrame:
    """All filings of a delivery with their ``document`` and what is to become of them, written once.

    ``status`` is ready, left out (no financial form) or waiting (company unknown).
    """
    known = submissions.withColumn("document", _document(submissions, "submissions")).join(
        company_ids(catalog.table("company_identifiers")), "cik", "left"
    )
    financial = F.coalesce(rules.is_financial_form(F.col("form")), F.lit(False))
    status = F.when(~financial, "left out").when(F.col("company_id").isNull(), "waiting").otherwise("ready")
    return written_once(known.withColumn("status", status), "filings", below)


def store_filings(catalog: Catalog, staged: DataFrame, provider_id: str) -> WriteStats:
    """Store the new ones of staged filings, linked to the newest registered document of their company."""
    documents = latest_by(
        catalog.table("raw_documents").where(F.col("provider_id") == provider_id), ["source_identifier"],
        ["retrieved_at", "id"],
    ).select(F.col("source_identifier").alias("_document"), F.col("id").alias("raw_document_id"))
    rows = _filing_columns(staged.where("status = 'ready'"), provider_id)
    named = rows.withColumn("_document", F.concat(F.lit("submissions:"), "cik"))
    return insert_guarded(
        catalog.store("filings"), named.join(documents, "_document", "left").drop("_document", "cik"),
        NATURAL_KEYS["filings"],
    )


def ingest_filings(catalog: Catalog, submissions: DataFrame, provider_id: str) -> WriteStats:
    """Store new filings, linked to the newest registered submissions document of their company."""
    return store_filings(catalog, stage_filings(catalog, submissions), provider_id)


# --- facts --------------------------------------------------------------------


def _reported(values: DataFrame) -> list[Column]:
    """What facts are made from, each part once, as joins carry it."""
    return [
        F.col("cik"), F.col("namespace"), F.col("concept"),
        rules.value(F.col("val")).alias("value"),
        rules.unit(F.col("unit"), F.col("fact_unit")).alias("unit"),
        F.col("start"), F.col("end"),
        rules.fiscal_year(F.col("end"), F.col("fy")).alias("fiscal_year"),
        rules.fiscal_period(F.col("fp")).alias("fiscal_period"),
        F.col("form"), F.col("filed"),
        keys.accession(F.col("accn")).alias("accession_number"),
        F.col("frame"),
    ]


def _fact_columns() -> list[Column]:
    """Typed fact columns from reported parts."""
    start, end = F.col("start"), F.col("end")
    instant = rules.is_instant(start, end)
    return [
        *[F.col(c) for c in ("cik", "namespace", "concept", "value", "unit")],
        F.when(~instant, start).alias("period_start"),
        end.alias("period_end"),
        *[F.col(c) for c in ("fiscal_year", "fiscal_period", "form")],
        F.col("filed").alias("filing_date"),
        F.col("accession_number"),
        # The number without dashes stays as it is when dashes are taken out again.
        rules.source_id(F.col("accession_number"), F.col("namespace"), F.col("concept"), start, end).alias("source_id"),
        F.col("frame"),
        instant.alias("is_instant"),
    ]


def link_filings(facts: DataFrame, filings: DataFrame) -> DataFrame:
    """Facts with the id of the stored filing they were reported in, else NULL."""
    stored = filings.select("company_id", "accession_number", F.col("id").alias("filing_id"))
    return facts.join(stored, ["company_id", "accession_number"], "left")


def _numeric() -> Column:
    return F.col("val").isNull() | F.col("val").try_cast("double").isNotNull()


def _usable(values: DataFrame) -> DataFrame:
    return values.where(_numeric()).select(*_reported(values)).where("fiscal_year IS NOT NULL")


def normalize_facts(values: DataFrame) -> DataFrame:
    """Reported values as typed fact rows.

    Values that are no number, or that belong to no year, are left out. A missing
    value, or a number beyond the stored type, is NULL and is rejected by validation.
    """
    return _usable(values).select(*_fact_columns())


def validate_facts(facts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Valid rows, and rejected rows with the messages of the rules they break."""
    instant = F.col("is_instant") if "is_instant" in facts.columns else None
    fine = rules.is_valid(instant)
    return facts.where(fine), facts.where(~fine).withColumn("errors", rules.errors(instant))


def fact_rows(values: DataFrame, identifiers: DataFrame, filings: DataFrame, provider_id: str) -> DataFrame:
    """Linked facts of known companies, before validation."""
    linked = link_filings(_usable(values).join(company_ids(identifiers), "cik"), filings)
    return linked.select(*_fact_columns(), "company_id", "filing_id", F.lit(provider_id).alias("provider_id"))


#: Parts of a delivery, by company number, that can be linked one after the other.
SLICES = 8


def _slice(cik: str) -> Column:
    return F.pmod(F.xxhash64(cik), F.lit(SLICES)).cast("int")


def stage_facts(catalog: Catalog, values: DataFrame, provider_id: str, below: str | None = None) -> DataFrame:
    """All reported values of a delivery with their ``document`` and what is to become of them, written once.

    ``status`` is ready, rejected (with the ``errors``), left out (no number, or of no
    year) or waiting (company unknown). The values are kept by company number first, so
    that a large delivery is joined in rounds, and then by year, as they are stored.
    """
    root = f"{below or scratch_dir(catalog.spark)}"
    named = [c for c in ("source_identifier",) if c in values.columns]
    every = values.select(*_reported(values), _numeric().alias("is_number"), *named, _slice("cik").alias("_slice"))
    place, path = f"{root}/values-{uuid4().hex}", f"{root}/facts-{uuid4().hex}"
    kept = written(every, place, ["_slice"], ["cik"])
    numbers = company_ids(catalog.table("company_identifiers")).withColumn("_slice", _slice("cik"))
    filings = catalog.table("filings")
    for slices in rounds((part, rows) for (part,), rows in rows_by_partition(kept, ["_slice"])):
        known = kept.where(F.col("_slice").isin(slices)).drop("_slice").join(
            numbers.where(F.col("_slice").isin(slices)).drop("_slice"), "cik", "left"
        )
        linked = link_filings(known, filings).select(
            *_fact_columns(), "start", "is_number", *named, "company_id", "filing_id",
        ).withColumn("errors", F.array_join(rules.errors(F.col("is_instant")), "; "))
        usable = F.col("is_number") & F.col("fiscal_year").isNotNull()
        status = (
            F.when(~usable, "left out").when(F.col("company_id").isNull(), "waiting")
            .when(F.col("errors") != "", "rejected").otherwise("ready")
        )
        # What follows from columns that are kept is not kept.
        staged = written(
            linked.withColumn("status", status).drop("source_id"), path, ["fiscal_year"], ["company_id", "accession_number"]
        )
        for part in slices:
            forget(catalog.spark, f"{place}/_slice={part}")
    forget(catalog.spark, place)
    source = rules.source_id(F.col("accession_number"), F.col("namespace"), F.col("concept"), F.col("start"), F.col("period_end"))
    return staged.withColumns(
        {"source_id": source, "document": _document(staged, "facts"), "provider_id": F.lit(provider_id)}
    ).drop("start", *named)


def store_facts(catalog: Catalog, staged: DataFrame, run_id: str | None = None) -> WriteStats:
    """Store the new facts among staged ones, and the rejected ones with their messages.

    Rejected rows count as processed and skipped.
    """
    fact_id = keys.row_id(F.lit("fact"), *NATURAL_KEYS["financial_facts"])
    ready = staged.where("status = 'ready'")
    stats = insert_guarded(
        catalog.store("financial_facts"), ready.select(*[c for c in schema("financial_facts").names if c in ready.columns]),
        NATURAL_KEYS["financial_facts"], prune=["fiscal_year"], derived={"id": fact_id}, at_rest=True,
    )
    rejects = staged.where("status = 'rejected'").withColumn("run_id", F.lit(run_id).cast("string"))
    lost = insert_new(catalog.store("fact_rejects"), rejects, NATURAL_KEYS["fact_rejects"]).processed
    return stats + WriteStats(processed=lost, skipped=lost)


def ingest_facts(catalog: Catalog, values: DataFrame, provider_id: str) -> tuple[WriteStats, DataFrame]:
    """Store new facts and rejects; returns the counters and the rejected rows."""
    staged = stage_facts(catalog, values, provider_id)
    return store_facts(catalog, staged), staged.where("status = 'rejected'")


# --- prices -------------------------------------------------------------------


def listing_symbols(listings: DataFrame, exchanges: DataFrame, feed: str = "quotes") -> DataFrame:
    """Active listings with their symbol in a feed; unsupported exchanges drop out."""
    codes = exchanges.select(F.col("id").alias("exchange_id"), F.col("code").alias("exchange_code"))
    return (
        listings.where("is_active").join(codes, "exchange_id")
        .select(F.col("id").alias("listing_id"),
                keys.quote_symbol(F.col("ticker"), F.col("exchange_code"), feed).alias("symbol"))
        .where("symbol IS NOT NULL")
    )


def to_prices(bars: DataFrame, provider_id: str, label: str) -> DataFrame:
    """Price rows from feed bars: adjusted close is the close, currency the dollar."""
    return bars.select(
        keys.row_id(F.lit("price"), "listing_id", "price_date", F.lit(provider_id)).alias("id"),
        "listing_id", F.lit(provider_id).alias("provider_id"), "price_date",
        "open", "high", "low", "close", F.col("close").alias("adjusted_close"), "volume",
        F.lit("USD").alias("currency"), F.concat(F.lit(f"{label}:"), "symbol").alias("source_id"),
    )


def price_rows(
    listings: DataFrame, exchanges: DataFrame, bars: DataFrame, provider_id: str, feed: str = "quotes",
    label: str = "quotes",
) -> DataFrame:
    """The newest bar of every active listing that the feed knows."""
    newest = latest_by(bars, ["symbol"], ["price_date", "close", "volume"])
    return to_prices(listing_symbols(listings, exchanges, feed).join(newest, "symbol"), provider_id, label)


def ingest_prices(
    catalog: Catalog, bars: DataFrame, provider_id: str, feed: str = "quotes", label: str = "quotes"
) -> WriteStats:
    rows = price_rows(
        catalog.table("company_listings"), catalog.table("exchanges"), bars, provider_id, feed, label
    )
    return insert_guarded(
        catalog.store("prices"), rows.withColumn("price_year", F.year("price_date")), NATURAL_KEYS["prices"],
        prune=["price_year"],
    )


# --- currency rates -----------------------------------------------------------


def fx_cross(per_eur: DataFrame) -> DataFrame:
    """Dollars per unit from a table of units per euro (currency, rate_date, per_eur).

    A currency is crossed with the dollar series of the same day; EUR is that
    series itself. Days without a positive quote on either side give no row, and
    the dollar, worth itself, gets none.
    """
    usd = per_eur.where("currency = 'USD' AND per_eur > 0").groupBy("rate_date").agg(
        F.max("per_eur").alias("usd_per_eur")
    )
    others = per_eur.where("currency NOT IN ('USD', 'EUR') AND per_eur > 0")
    crossed = others.join(usd, "rate_date").select(
        "currency", "rate_date", (F.col("usd_per_eur") / F.col("per_eur")).alias("usd_per_unit")
    )
    euro = usd.select(F.lit("EUR").alias("currency"), "rate_date", F.col("usd_per_eur").alias("usd_per_unit"))
    return crossed.unionByName(euro)


def choose_fx(primary: DataFrame, fallback: DataFrame, labels: tuple[str, str] = ("ecb", "pairs")) -> DataFrame:
    """Primary rates per currency; the fallback only for currencies without any."""
    published = (*constants.EURO_REFERENCE_CURRENCIES, "EUR")
    first = primary.where(F.col("currency").isin(*published)).withColumn("source", F.lit(labels[0]))
    rest = fallback.where("currency <> 'USD'").join(first.select("currency"), "currency", "left_anti")
    return first.unionByName(rest.withColumn("source", F.lit(labels[1])))


def load_fx_rates(
    catalog: Catalog, per_eur: DataFrame, fallback: DataFrame | None = None, currencies: list[str] | None = None
) -> int:
    """Upsert daily dollar rates of the supported currencies; returns the rows stored."""
    codes = currencies or list(constants.currency_codes())
    unknown = set(codes) - set(constants.currency_codes())
    if unknown:
        raise ValueError(f"unknown currencies {sorted(unknown)}")
    crossed = fx_cross(per_eur)
    chosen = choose_fx(crossed, crossed.limit(0) if fallback is None else fallback)
    rates = chosen.where(F.col("currency").isin(*codes)).select(
        "currency", "rate_date", F.col("usd_per_unit").cast("decimal(24,10)").alias("usd_per_unit"), "source"
    ).where("usd_per_unit > 0")
    upsert(catalog.store("fx_rates"), rates, NATURAL_KEYS["fx_rates"], "source")
    return catalog.table("fx_rates").count()


# --- enrichment ---------------------------------------------------------------


def sector_targets(
    companies: DataFrame, listings: DataFrame, exchanges: DataFrame, attempted: DataFrame | None = None
) -> DataFrame:
    """Companies without a sector, one US-listed ticker each, not attempted before."""
    us = exchanges.where(F.upper("code").isin(*constants.US_QUOTE_EXCHANGES)).select(F.col("id").alias("exchange_id"))
    rows = (
        listings.where("is_active").join(us, "exchange_id", "left_semi")
        .join(companies.where("sector IS NULL").select(F.col("id").alias("company_id"), "legal_name"), "company_id")
        .withColumn("_key", F.upper("ticker"))
    )
    if attempted is not None:
        rows = rows.join(attempted.select(F.upper("ticker").alias("_key")), "_key", "left_anti")
    return preferred(rows, ["company_id"], [F.col("is_primary").desc_nulls_last(), "ticker"]).select(
        "company_id", "ticker", "legal_name"
    )


def enriched_companies(companies: DataFrame, targets: DataFrame, feed: DataFrame) -> DataFrame:
    """Companies with sector and industry filled in where the feed knows the ticker."""
    found = targets.select(F.col("company_id").alias("id"), F.upper("ticker").alias("ticker")).join(feed, "ticker")
    return patch_rows(companies, found.select("id", "sector", "industry"), ["id"], ["sector", "industry"])


def enrich_sector(catalog: Catalog, feed: DataFrame, attempted: DataFrame | None = None) -> None:
    def enriched(companies: DataFrame) -> DataFrame:
        targets = sector_targets(companies, catalog.table("company_listings"), catalog.table("exchanges"), attempted)
        return enriched_companies(companies, targets, feed)

    change(catalog.store("companies"), enriched)


# --- everything ---------------------------------------------------------------


def document_rows(scan: DataFrame, provider_id: str) -> DataFrame:
    """Scanned files with their id: a changed file is a further version, with an id of its own."""
    return scan.select(
        # Documents are found by their id, which those of earlier deliveries have at full length.
        keys.row_id(F.lit("document"), F.lit(provider_id), "source_identifier", "checksum", digits=64).alias("id"),
        F.lit(provider_id).alias("provider_id"), "source_identifier", "storage_path", "checksum", "content_type",
    )


def register_documents(catalog: Catalog, scan: DataFrame, provider_id: str, now) -> WriteStats:
    """Store registry rows of raw files, one per content: a changed file is a further version of it."""
    rows = document_rows(scan, provider_id).withColumns(
        {"retrieved_at": F.lit(now).cast("timestamp"), "is_processed": F.lit(False)}
    )
    return insert_new(catalog.store("raw_documents"), rows, NATURAL_KEYS["raw_documents"])


def mark_processed(catalog: Catalog, found: DataFrame) -> None:
    """Flag the registered documents (column id) as processed."""
    store = catalog.store("raw_documents")
    if store.version():
        change(store, lambda rows: mark(rows, found, "id", "is_processed"))


def mark_synced(catalog: Catalog, companies: DataFrame, now) -> None:
    """Stamp the companies (column company_id) as synchronised."""
    stamped = companies.select(F.col("company_id").alias("id")).distinct().withColumn(
        "last_synced_at", F.lit(now).cast("timestamp")
    )
    patch(catalog.store("companies"), stamped, ["id"], ["last_synced_at"])


def outcomes(staged: DataFrame, step: str, error: str | None = None) -> DataFrame:
    """What became of each document's rows in a step; after an error none is stored."""
    def count(status: str) -> Column:
        return F.count_if(F.col("status") == status)

    ready = F.lit(0).cast("bigint") if error else count("ready")
    return staged.groupBy(F.col("document").alias("source_identifier")).agg(
        F.count("*").alias("records_read"), ready.alias("records_stored"), count("rejected").alias("records_rejected"),
        count("left out").alias("records_left_out"), count("waiting").alias("records_waiting"),
    ).withColumns({"step": F.lit(step), "error": F.lit(error).cast("string")})


def settled_documents(raw: DataFrame, found: DataFrame, failed: bool) -> DataFrame:
    """Documents of a delivery that need not come again.

    Of such a document every row was stored, rejected or left out. One that gave no
    rows counts if no step failed, as a failed step may be the one it is for.
    """
    done = F.col("records_stored") + F.col("records_rejected") + F.col("records_left_out")
    each = found.groupBy("source_identifier").agg(F.bool_and(F.col("records_read") == done).alias("_settled"))
    return raw.join(each, "source_identifier", "left").where(F.coalesce("_settled", F.lit(not failed))).drop("_settled")


def sync(
    catalog: Catalog,
    universe: DataFrame,
    submissions: DataFrame,
    values: DataFrame,
    provider_id: str,
    now,
    raw: DataFrame | None = None,
    rejected: DataFrame | None = None,
    pipeline: str = "sync",
) -> Mapping[str, WriteStats]:
    """Universe, then filings, then facts (which link to filings), for all companies at once.

    Facts wait when the filings could not be stored. The run is recorded: opened before
    anything is written and closed with the sums of all counters, as partial if a step
    reports an error and as failed if one raises. What became of the rows of each
    document is noted in ``document_outcomes``, what validation rejects in
    ``fact_rejects``. ``raw`` (a scan of the files) is registered first; of its
    documents, by identifier and checksum, those are flagged as processed last whose
    rows are all accounted for. ``rejected`` documents count as skipped and are not
    flagged. Rows name their document in ``source_identifier``; where the column is
    missing it is ``submissions:`` or ``facts:`` and the company's number.
    """
    trail, run_id = catalog.store("import_runs"), f"{pipeline}:{provider_id}:{now}"
    staging = f"{scratch_dir(catalog.spark)}/sync-{uuid4().hex}"
    runs.start_run(trail, run_id, provider_id, pipeline, now)
    stats: dict[str, WriteStats] = {}
    try:
        if raw is not None:
            stats["documents"] = register_documents(catalog, raw, provider_id, now)
        if rejected is not None:
            with releasing(catalog.spark):
                lost = rejected.count()
            stats["rejected"] = WriteStats(processed=lost, skipped=lost)
        stats |= ingest_universe(catalog, universe, provider_id)
        filings = stage_filings(catalog, submissions, staging)
        stats["filings"] = store_filings(catalog, filings, provider_id)
        found = outcomes(filings, "filings", stats["filings"].error)
        if stats["filings"].error:
            stats["facts"] = WriteStats(error="facts wait for the filings")
        else:
            facts = stage_facts(catalog, values, provider_id, staging)
            stats["facts"] = store_facts(catalog, facts, run_id)
            found = found.unionByName(outcomes(facts, "facts", stats["facts"].error))
        failed = any(s.error for s in stats.values())
        noted = written_once(found.withColumn("run_id", F.lit(run_id)), "outcomes", staging)
        insert_new(catalog.store("document_outcomes"), noted, NATURAL_KEYS["document_outcomes"])
        if not failed:
            synced = company_ids(catalog.table("company_identifiers")).join(
                parse_companies(universe).select("cik"), "cik", "left_semi"
            )
            mark_synced(catalog, synced, now)
        if raw is not None:
            done = settled_documents(document_rows(raw, provider_id), noted, failed)
            if rejected is not None and "source_identifier" in rejected.columns:
                done = absent_keys(done, rejected.select("source_identifier"), ["source_identifier"])
            mark_processed(catalog, done.select("id"))
    except Exception as error:
        broken = sum(stats.values(), WriteStats(error=f"{type(error).__name__}: {error}"[:500]))
        runs.finish_run(trail, run_id, broken, now, status="failed")
        raise
    finally:
        # Whatever was staged is stored or given up by now.
        forget(catalog.spark, staging)
    runs.finish_run(trail, run_id, sum(stats.values(), WriteStats()), now)
    return stats


def refresh_core(catalog: Catalog, **options) -> DataFrame:
    """Rebuild the yearly financials from the stored facts and rates."""
    return core_financials(catalog.table("financial_facts"), catalog.table("fx_rates"), **options)


def seed(catalog: Catalog, spark: SparkSession) -> None:
    """Store the packaged exchanges, currencies and tag mapping as tables."""
    exchanges = constants.table(spark, "exchanges").select(
        keys.row_id(F.lit("exchange"), "code").alias("id"), "code", "name", "country", "timezone", "currency",
        F.lit(True).alias("is_active"),
    )
    insert_new(catalog.store("exchanges"), exchanges, ["code"])
    insert_new(catalog.store("fx_currencies"), constants.table(spark, "currencies"), ["code"])
    insert_new(catalog.store("concept_normalization"), constants.table(spark, "tag_mapping"), ["namespace", "concept"])
