"""Regulatory JSON documents and raw files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from periodica import schemas
from periodica.functions import facts as rules
from periodica.functions import keys

FILE_URL = "https://www.sec.gov/Archives/edgar/data/"


def _whole_files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path, wholetext=True, recursiveFileLookup=True)


def _filled(value: Column) -> Column:
    return F.nullif(value, F.lit(""))


def parse_universe(documents: DataFrame, column: str = "value") -> DataFrame:
    """Companies of a universe document, one row each.

    Two layouts occur: ``{"data": [[cik, name, ticker, exchange, ...], ...]}`` and
    ``{"0": {"cik_str": ..., "ticker": ..., "title": ...}, ...}``. Short, NULL and
    non-numeric entries are skipped.
    """
    listed = F.from_json(column, "struct<data:array<array<string>>>")["data"]
    keyed = F.from_json(column, "map<string,string>")
    both = documents.select(listed.alias("_list"), keyed.alias("_map")).withColumn(
        "_is_list", F.col("_list").isNotNull()
    )

    def cell(i: int) -> Column:
        return F.try_element_at("_item", F.lit(i + 1))

    from_list = (
        both.where("_is_list")
        .select(F.explode_outer("_list").alias("_item"))
        .where((F.size("_item") >= 3) & cell(0).rlike(r"^\d+$"))
        .select(
            keys.cik(cell(0)).alias("cik"), cell(1).alias("name"), _filled(cell(2)).alias("ticker"),
            _filled(cell(3)).alias("exchange"), _filled(cell(4)).alias("sic"),
            _filled(cell(5)).alias("sic_description"), _filled(cell(6)).alias("owner_org"),
        )
    )
    entry = F.from_json("value", "struct<cik_str:string,ticker:string,title:string>")
    from_map = (
        both.where(~F.col("_is_list"))
        .select(F.explode_outer("_map"))
        .where(F.col("key").rlike(r"^\d+$"))
        .select(entry.alias("e"))
        .where("e.cik_str RLIKE '^[0-9]+$' AND e.ticker IS NOT NULL AND e.title IS NOT NULL")
        .select(
            keys.cik(F.col("e.cik_str")).alias("cik"), F.col("e.title").alias("name"),
            F.col("e.ticker").alias("ticker"), F.lit("").alias("exchange"),
        )
    )
    return from_list.unionByName(from_map, allowMissingColumns=True)


def read_universe(spark: SparkSession, path: str) -> DataFrame:
    return parse_universe(_whole_files(spark, path))


def parse_submissions(documents: DataFrame, column: str = "value") -> DataFrame:
    """Filings of submission documents: parallel arrays turned into rows."""
    recent = "doc.filings.recent"
    names = (
        "accessionNumber", "filingDate", "reportDate", "form",
        "primaryDocument", "primaryDocDescription", "fy", "fp",
    )
    # A missing array must not void the others, so it is zipped as an empty one.
    arrays = [
        F.coalesce(f"{recent}.{n}", F.array().cast("array<int>" if n == "fy" else "array<string>")).alias(n) for n in names
    ]
    rows = (
        documents.select(F.explode(F.array(F.from_json(column, schemas.SUBMISSIONS))).alias("doc"))
        .select("doc.cik", F.explode_outer(F.arrays_zip(*arrays)).alias("f"))
        .select(keys.cik(F.col("cik")).alias("cik"), *[F.col(f"f.{n}").alias(n) for n in names])
        .where("accessionNumber IS NOT NULL")
    )
    number = keys.accession(F.col("accessionNumber"))
    holder = F.regexp_replace("cik", "^0+(?=.)", "")
    return rows.select(
        "cik",
        number.alias("accession_number"),
        "form",
        rules.date(F.col("filingDate")).alias("filing_date"),
        rules.date(F.col("reportDate")).alias("period_end"),
        F.col("fy").alias("fiscal_year"),
        F.col("fp").alias("fiscal_period"),
        F.concat(
            F.lit(FILE_URL), holder, F.lit("/"), number, F.lit("/"), F.coalesce("primaryDocument", F.lit(""))
        ).alias("filing_url"),
        F.coalesce(F.col("form").endswith("/A"), F.lit(False)).alias("is_amended"),
        F.col("primaryDocument").alias("primary_document"),
        F.col("primaryDocDescription").alias("primary_doc_description"),
    )


def read_submissions(spark: SparkSession, path: str) -> DataFrame:
    return parse_submissions(_whole_files(spark, path))


def _parts(text: Column) -> Column:
    several = F.split(text, r"(?<=\})\s*\n\s*(?=\{)")
    return F.explode_outer(F.when(F.contains(text, F.lit("\n")), several).otherwise(F.array(text)))


def _quoted(text: Column) -> Column:
    return F.regexp_replace(text, r'"val"\s*:\s*(-?[0-9][0-9.eE+-]*)', '"val":"$1"')


# What a document of each kind must have for its rows to be read.
_KINDS = {
    "facts": (schemas.COMPANY_FACTS, ("cik", "facts")),
    "submissions": (schemas.SUBMISSIONS, ("cik", "filings")),
    "universe": ("map<string,string>", ()),
}


def rejected_documents(documents: DataFrame, kind: str, column: str = "value") -> DataFrame:
    """Documents that give no rows because they cannot be read, with the ``reason``.

    The other columns of ``documents`` (a path, an identifier) are kept, the text is
    not. An empty or NULL document counts as unreadable.
    """
    declared, needed = _KINDS[kind]
    kept = [c for c in documents.columns if c != column]
    parts = documents.select(*kept, (_parts(F.col(column)) if kind == "facts" else F.col(column)).alias("_part"))
    text = _quoted(F.col("_part")) if kind == "facts" else F.col("_part")
    if kind == "universe":
        checked = parts.withColumn("_doc", F.explode(F.array(F.from_json(text, declared))))
        broken = F.col("_doc").isNull()
    else:
        marked = declared.replace("struct<", "struct<_broken:string,", 1)
        parsed = F.from_json(text, marked, {"columnNameOfCorruptRecord": "_broken"})
        checked = parts.withColumn("_doc", F.explode(F.array(parsed)))
        broken = F.col("_doc").isNull() | F.col("_doc._broken").isNotNull()
    reason = F.when(F.col("_part").isNull() | (F.trim("_part") == ""), "document is empty").when(broken, "not valid JSON")
    for field in needed:
        reason = reason.when(F.col(f"_doc.{field}").isNull(), f"{field} is missing")
    return checked.withColumn("reason", reason).where("reason IS NOT NULL").select(*kept, "reason")


def parse_company_facts(documents: DataFrame, column: str = "value") -> DataFrame:
    """Reported values of company-facts documents, one row each, numbers as text.

    Numbers are quoted before parsing so that no digit is lost; a value that is null
    or absent stays NULL and is for validation to reject. Several documents may
    follow each other in one file, separated by a line break, which JSON strings
    cannot contain.
    """

    def typed(v: Column) -> Column:
        # Evaluated once per value, below the explode, where no later filter repeats it.
        return F.struct(
            v["val"].alias("val"),
            rules.date(v["start"]).alias("start"), rules.date(v["end"]).alias("end"), v["accn"].alias("accn"),
            v["fy"].alias("fy"), v["fp"].alias("fp"), v["form"].alias("form"),
            rules.date(v["filed"]).alias("filed"), v["frame"].alias("frame"),
        )

    # The parsed document stands behind an explode, below which no filter on its fields
    # can go, so it is parsed once whatever is joined to the result.
    return (
        documents.select(_parts(F.col(column)).alias("part"))
        .select(F.explode(F.array(F.from_json(_quoted(F.col("part")), schemas.COMPANY_FACTS))).alias("doc"))
        .select(keys.cik(F.col("doc.cik")).alias("cik"), F.col("doc.entityName").alias("entity_name"),
                F.explode_outer("doc.facts").alias("namespace", "concepts"))
        .where("namespace IS NOT NULL")
        .select("cik", "entity_name", "namespace", F.explode("concepts").alias("concept", "fact"))
        .select("cik", "entity_name", "namespace", "concept", F.col("fact.unit").alias("fact_unit"),
                F.explode("fact.units").alias("unit", "values"))
        .select("cik", "entity_name", "namespace", "concept", "fact_unit", "unit",
                F.explode_outer(F.transform("values", typed)).alias("v"))
        .where("v IS NOT NULL")
        .select("cik", "entity_name", "namespace", "concept", "fact_unit", "unit", "v.*")
    )


def read_company_facts(spark: SparkSession, path: str) -> DataFrame:
    return parse_company_facts(_whole_files(spark, path))


def checksums(documents: DataFrame, content: str, source_identifier: Column, storage_path: Column) -> DataFrame:
    """Registry rows of raw contents."""
    return documents.select(
        source_identifier.alias("source_identifier"),
        storage_path.alias("storage_path"),
        F.sha2(content, 256).alias("checksum"),
        F.when(storage_path.endswith(".json"), "application/json")
        .when(storage_path.endswith(".csv"), "text/csv")
        .otherwise("application/octet-stream").alias("content_type"),
    )


def scan_raw_documents(spark: SparkSession, path: str) -> DataFrame:
    """Path, checksum and content type of every file below a folder.

    The identifier is the kind (parent folder) and the file name without ending.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    parts = F.split("path", "/")
    name = F.regexp_replace(F.element_at(parts, -1), r"\.[^.]*$", "")
    return checksums(files, "content", F.concat_ws(":", F.try_element_at(parts, F.lit(-2)), name), F.col("path"))
