"""Readers over small files."""

import datetime
import json
from decimal import Decimal

import pytest

from periodica.sources import documents, series
from periodica.sources.tables import literal_table

DAY = datetime.date


def write(tmp_path, name, text):
    path = tmp_path / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    return str(path)


def test_universe_layouts(spark, tmp_path):
    listed = {"data": [["320193", "Apple", "aapl", "Nasdaq", "3571"], None, ["1", "x"], ["a1", "bad", "T", "N"],
                       [789019, "Msft", None, ""]]}
    keyed = {"0": {"cik_str": 320193, "ticker": "AAPL", "title": "Apple"}, "1": {"cik_str": "x", "ticker": "B", "title": "B"},
             "2": {"cik_str": 5, "title": "no ticker"}, "meta": {"cik_str": 7, "ticker": "C", "title": "C"}}
    rows = documents.read_universe(spark, write(tmp_path, "a.json", json.dumps(listed))).orderBy("cik").collect()
    assert [(r.cik, r.ticker, r.exchange, r.sic) for r in rows] == [
        ("0000320193", "aapl", "Nasdaq", "3571"), ("0000789019", None, None, None)]
    rows = documents.read_universe(spark, write(tmp_path, "b.json", json.dumps(keyed))).collect()
    assert [(r.cik, r.name, r.ticker, r.exchange) for r in rows] == [("0000320193", "Apple", "AAPL", "")]


def test_submissions_with_missing_arrays(spark, tmp_path):
    recent = {"accessionNumber": ["0000320193-23-000106", "0000320193-23-000010"], "filingDate": ["2023-11-03", ""],
              "reportDate": ["", "2023-06-24"], "form": ["10-K/A", "10-Q"], "primaryDocument": ["a.htm", "b.htm"]}
    path = write(tmp_path, "s.json", json.dumps({"cik": "320193", "name": "Apple", "filings": {"recent": recent}}, indent=1))
    rows = documents.read_submissions(spark, path).orderBy("accession_number").collect()
    assert [(r.accession_number, r.filing_date, r.period_end, r.is_amended, r.fiscal_year) for r in rows] == [
        ("000032019323000010", None, DAY(2023, 6, 24), False, None),
        ("000032019323000106", DAY(2023, 11, 3), None, True, None)]
    assert rows[1].filing_url == "https://www.sec.gov/Archives/edgar/data/320193/000032019323000106/a.htm"


def facts_text(cik, val, **more):
    item = {"end": "2023-09-30", "accn": "0-1", "fy": 2023, "fp": "FY", "form": "10-K", "filed": "2023-11-03", **more}
    text = json.dumps({"cik": cik, "entityName": "A", "facts": {"us-gaap": {"Assets": {"label": "{x}", "units": {"USD": [item]}}}}},
                      indent=1)
    return text.replace('"end"', f'"val" : {val}, "end"')


def test_company_facts_keep_every_digit(spark, tmp_path):
    digits = "123456789012345678901234567890.123456789012345678"
    path = write(tmp_path, "f.json", facts_text(320193, digits, start="2022-13-40"))
    row = documents.read_company_facts(spark, path).first()
    assert (row.cik, row.val, row.start, row.end, row.unit) == ("0000320193", digits, None, DAY(2023, 9, 30), "USD")


def test_several_documents_in_one_file(spark, tmp_path):
    text = facts_text(1, "10") + "\n\n" + facts_text(2, "-2.5e3")
    rows = documents.read_company_facts(spark, write(tmp_path, "m.json", text)).orderBy("cik").collect()
    assert [(r.cik, r.val) for r in rows] == [("0000000001", "10"), ("0000000002", "-2.5e3")]


def test_fx_csv(spark, tmp_path):
    text = ("KEY,FREQ,CURRENCY,CURRENCY_DENOM,EXR_TYPE,EXR_SUFFIX,TIME_PERIOD,OBS_VALUE\n"
            "k,D,USD,EUR,SP00,A,2024-12-20,1.039\nk,D,USD,EUR,SP00,A,2024-12-23,1.0393\nk,D,USD,EUR,SP00,A,2024-12-24,\n"
            "k,D,USD,EUR,SP00,A,bad,1.1\nk,D,USD,EUR,SP00,A,2024-12-27,x\n")
    rows = series.read_fx_csv(spark, write(tmp_path, "fx.csv", text)).orderBy("rate_date").collect()
    assert [tuple(r) for r in rows] == [("USD", DAY(2024, 12, 20), 1.039), ("USD", DAY(2024, 12, 23), 1.0393)]


def test_pairs_prefer_the_direct_quote(spark):
    closes = literal_table(spark, [("GBPUSD", DAY(2024, 1, 2), 1.25), ("USDGBP", DAY(2024, 1, 2), 0.9),
                                   ("ILSUSD", DAY(2024, 1, 2), 0.0), ("USDILS", DAY(2024, 1, 2), 4.0)],
                           "pair string, rate_date date, close double")
    wanted = literal_table(spark, [("GBP",), ("NIS",), ("JPY",)], "currency string")
    got = {r.currency: r.usd_per_unit for r in series.fx_from_pairs(closes, wanted).collect()}
    assert got == {"GBP": 1.25, "NIS": 0.25}


def test_ohlcv_csv(spark, tmp_path):
    text = "Date,Open,High,Low,Close,Volume\n2024-01-02,1.5,2,1,1.75,100\n2024-01-03,,2,1,1.8,\n2024-01-04,x,2,1,1.8,5\nbad,1,2,1,1,1\n"
    write(tmp_path, "bars/aapl.us.csv", text)
    rows = series.read_ohlcv_csv(spark, str(tmp_path / "bars")).orderBy("price_date").collect()
    assert [(r.symbol, r.price_date, r.open, r.close, r.volume) for r in rows] == [
        ("aapl.us", DAY(2024, 1, 2), Decimal("1.5"), Decimal("1.75"), 100), ("aapl.us", DAY(2024, 1, 3), None, Decimal("1.8"), None)]


MEMBERS = """ticker,start_date,end_date
AAPL,1982-11-30,
BRK.B,1996-01-02,
ENRN,1996-01-02,2001-11-30
ENRN,2001-12-01,
AAPL,1982-11-30,1990-01-01
X,2020-01-01,2020-01-01
,2020-01-01,
"""


def test_membership_csv(spark, tmp_path):
    rows = series.read_membership_csv(spark, write(tmp_path, "m.csv", MEMBERS)).orderBy("ticker", "start_date").collect()
    assert [tuple(r) for r in rows] == [
        ("AAPL", DAY(1982, 11, 30), None), ("BRK-B", DAY(1996, 1, 2), None),
        ("ENRN", DAY(1996, 1, 2), DAY(2001, 11, 30)), ("ENRN", DAY(2001, 12, 1), None)]


def test_membership_header_is_checked(spark, tmp_path):
    with pytest.raises(ValueError, match="end_date"):
        series.read_membership_csv(spark, write(tmp_path, "m.csv", "ticker,start\nAAPL,1982-11-30\n"))


def test_key_list_and_sector_feed(spark, tmp_path):
    keys = series.read_key_list(spark, write(tmp_path, "k.txt", "0000320193\n 789019 \n\n320193\n"))
    assert sorted(r.cik for r in keys.collect()) == ["0000320193", "0000789019"]
    feed = series.read_sector_feed(spark, write(tmp_path, "s.csv", "ticker,sector,industry\naapl,Tech,Phones\nko,,\npg,,Soap\n"))
    assert sorted((r.ticker, r.sector, r.industry) for r in feed.collect()) == [("AAPL", "Tech", "Phones"), ("PG", None, "Soap")]


def test_raw_documents(spark, tmp_path):
    import hashlib

    write(tmp_path, "raw/companyfacts/1.json", '{"a": 1}')
    row = documents.scan_raw_documents(spark, str(tmp_path / "raw")).first()
    assert (row.source_identifier, row.content_type) == ("companyfacts:1", "application/json")
    assert row.checksum == hashlib.sha256(b'{"a": 1}').hexdigest()


def test_rejected_documents(spark):
    good = '{"cik":1,"entityName":"n","facts":{"us-gaap":{"Assets":{"units":{"USD":[{"end":"2023-12-31","val":1}]}}}}}'
    rows = [("a", good), ("b", good[:60]), ("c", None), ("d", ""), ("e", '{"cik":1}'), ("f", good + "\n" + good[:50])]
    docs = spark.createDataFrame(rows, "path string, value string")
    got = {r.path: r.reason for r in documents.rejected_documents(docs, "facts").collect()}
    assert got == {"b": "not valid JSON", "c": "document is empty", "d": "document is empty", "e": "facts is missing", "f": "not valid JSON"}
    listing = spark.createDataFrame([("a", '{"data":[]}'), ("b", '{"data":[')], "path string, value string")
    assert [r.path for r in documents.rejected_documents(listing, "universe").collect()] == ["b"]
    subs = spark.createDataFrame([("a", '{"cik":"1","filings":{"recent":{}}}'), ("b", '{"cik":"1"}')], "path string, value string")
    assert [tuple(r) for r in documents.rejected_documents(subs, "submissions").collect()] == [("b", "filings is missing")]


def test_missing_values_are_rejected_not_zero(spark):
    from periodica.plans import ingest

    item = '{"end":"2023-12-31","accn":"1","fy":2023,"fp":"FY","form":"10-K","filed":"2024-02-01"%s}'
    text = '{"cik":1,"facts":{"us-gaap":{"Assets":{"units":{"USD":[' + ",".join(item % v for v in (',"val":null', "", ',"val":0')) + "]}}}}}"
    values = documents.parse_company_facts(spark.createDataFrame([(text,)], "value string"))
    valid, rejects = ingest.validate_facts(ingest.normalize_facts(values))
    assert [r.value for r in valid.collect()] == [0]
    assert [list(r.errors) for r in rejects.collect()] == [["value is required"]] * 2
