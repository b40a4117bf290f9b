"""Sheets, notes of verification, rounds of checks, and functions of names, refusals and waiting."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidewell.functions import contacts as ct
from tidewell.operators import importing, results, scheduling, sheets, verification

from .test_functions import one

A = B = C = D = E = None


@pytest.fixture(autouse=True)
def columns(spark):
    globals().update(A=F.col("a"), B=F.col("b"), C=F.col("c"), D=F.col("d"), E=F.col("e"))


def test_headers():
    assert sheets.map_headers(["Schools Name", "Country", "Name", "Surname"]) == {"institution_name": "Schools Name", "country_sheet": "Country"}
    assert sheets.map_headers(["Title", "City", "Website url"]) == {"institution_name": "Title", "seed_urls": "Website url"}
    assert sheets.map_headers(["Title", "Augstskola / Institution", "The website"]) == {"designation": "Title", "institution_name": "Augstskola / Institution", "seed_urls": "The website"}
    assert sheets.map_headers(["Institution type", "Name", "E-mail"])["institution_name"] == "Name"
    assert sheets.map_headers(["Name", "University"])["institution_name"] == "University"
    with pytest.raises(ValueError, match="no column"):
        sheets.map_headers(["Phone", "Country"])
    assert sheets.looks_like_data(["Graz School", "+43 316"]) and sheets.looks_like_data(["x", "a@b.org"]) and not sheets.looks_like_data(["University", "", "Phone 1"])


def sheet(spark, rows):
    return spark.createDataFrame([(k, r) for k, r in enumerate(rows)], "n long, cells array<string>").repartition(3)


def test_sheet_with_headings(spark):
    rows = [["University", "Name", "Surname", "Website"], ["Graz School", "Eva", "Lang", "see https://g.at, http://h.at"], ["A\nB", "Jo", "", "https://x.org"], ["", "Nobody", "", ""], ["123", "", "", ""], ["Last One", "", "Only", "www.no.org"]]
    got = [tuple(r) for r in sheets.batch_rows(sheet(spark, rows)).select("row_id", "institution_name", "contact_name", "seed_urls", "flags").orderBy("row_id").collect()]
    split = "split from merged cell - verify pairing"
    assert got == [("r001", "Graz School", "Eva Lang", "https://g.at http://h.at", ""), ("r002", "A", "Jo", "https://x.org", split), ("r003", "B", "Jo", "https://x.org", split), ("r006", "Last One", "Only", "", "")]
    part = sheets.batch_rows(sheet(spark, rows), start=2, limit=1).select("row_id", "institution_name").orderBy("row_id").collect()
    assert [tuple(r) for r in part] == [("r001", "A"), ("r002", "B")]
    assert sheets.batch_rows(sheet(spark, rows).limit(0)).collect() == []


def test_blank_heading(spark):
    rows = [["", "Country"], ["Lycée Jean Moulin", "FR"], ["C.C. Santa Maria la Real", "ES"], ["Graz School", "AT"]]
    assert [r["institution_name"] for r in sheets.batch_rows(sheet(spark, rows)).orderBy("row_id").collect()] == ["Lycée Jean Moulin", "C.C. Santa Maria la Real", "Graz School"]


def test_sheet_without_headings(spark):
    rows = [["1", "Grammar School North", "www.gsn.org"], ["2", "University of Graz", ""], ["3", "12345", "School of Music and Art"], ["4", "", ""]]
    got = sorted((r["n"], r["institution_name"], r["seed_urls"]) for r in sheets.headerless_rows(sheet(spark, rows)).collect())
    assert got == [(0, "Grammar School North", "https://www.gsn.org"), (1, "University of Graz", ""), (2, "School of Music and Art", "")]
    project = ["Erasmus+", *["x"] * 10, "Lycée Moulin", "FR", "https://erasmus-plus.ec.europa.eu/p", "https://lm.fr"]
    got = sheets.headerless_rows(sheet(spark, [project, ["LYCEE MOULIN", "7", "note", "https://other.fr"], project])).collect()
    assert [(r["institution_name"], r["country_sheet"], r["seed_urls"]) for r in got] == [("Lycée Moulin", "FR", "https://lm.fr")]


def test_cells_of_a_file(spark, tmp_path):
    (tmp_path / "s.csv").write_text('﻿University,Phone\n"Graz\nLinz","+43 1"\n,\n', encoding="utf-8")
    assert [r["cells"] for r in sheets.read_cells(spark, str(tmp_path / "s.csv")).orderBy("n").collect()] == [["University", "Phone"], ["Graz\nLinz", "+43 1"]]


def test_places_in_blocks(spark):
    got = sheets.numbered(spark.range(0, 300, 3), "id", "k", 10).orderBy("id").collect()
    assert [r["k"] for r in got] == list(range(1, 101))


def test_contact_notes(spark):
    who = [
        (1, "Eva Lang", "eva@g.at", "", "https://www.g.at/team", "Eva Lang ... officer", None, "g.at"), (2, "Eva Lang", "no@g.at", "0316 123 4567", "http://g.at/team", "nothing here", None, "other.at"), (3, None, "", "", "http://g.at/team", "x", None, "g.at"),
        (4, "Eva Lang", "", "", None, "x", None, "g.at"), (5, "Eva Lang", "", "", "http://g.at/lost", "x", None, "g.at"), (6, "Eva Lang", "eva@g.at", "", "http://g.at/team", "Eva Lang", "http://far.org/eva", "g.at"), (7, "Eva Lang", "e@far.org", "", "http://g.at/team", "Eva Lang", "http://far.org/eva", "g.at"),
    ]
    df = spark.createDataFrame(who, "id int, name string, email string, phone string, source_url string, evidence_quote string, email_source_url string, official string")
    pages = spark.createDataFrame([("http://g.at/team/", "Our team: Eva Lang, mobility officer, EVA@g.at", True), ("far.org/eva", "eva@g.at e@far.org", False)], "url string, text string, uncertified boolean")
    got = {r["id"]: (r["verified"], r["note"]) for r in verification.contact_notes(df, pages, "id").collect()}
    assert got == {
        1: (True, "name, email found on page (site certificate could not be verified)"), 2: (False, "quote not on page; email not on page; phone not on page; source not on the institute's own domain"), 3: (False, "no contact found"), 4: (False, "no source URL given"),
        5: (None, "cited page was not read by the fetcher (cannot check)"), 6: (True, "name, email found on page (site certificate could not be verified)"), 7: (False, "email is not on the institute's own domain"),
    }


def test_rechecks(spark):
    needs = lambda w: verification.needs_recheck(A, B, C, D, E, 2, w)
    base = {"a": "Graz School", "b": "g.at", "c": "", "d": "", "e": 0}
    ask = lambda w, **k: one(spark, needs(w), **(base | k))
    assert ask(False) and not ask(False, c="Eva") and not ask(False, e=2) and not ask(False, b="") and not ask(True)
    assert ask(True, d="Website not found") and not ask(True, d="Website not found", e=2) and ask(True, d="Website not found: search unavailable", e=2) and not ask(True, d="Website not found", a="34986419899")


def test_names_refusals_and_waiting(spark):
    assert one(spark, results.full_name(A, B), a=" Eva ", b="") == "Eva" and one(spark, results.full_name(A, B), a="Eva", b="Lang") == "Eva Lang"
    assert one(spark, results.query_name(A), a="Graz School - Campus, North") == "Graz School" and one(spark, results.query_name(A), a="Muster GmbH") == "Muster" and one(spark, results.query_name(A), a="Ag-Schule") == "Ag-Schule"
    assert tuple(one(spark, results.quota_message(A), a="Quota exceeded per day, retry in 31.5s")) == (True, 31.5) and tuple(one(spark, results.quota_message(A), a="slow down")) == (False, None)
    at = lambda h, m: dt.datetime(2024, 5, 1, h, m)
    df = spark.createDataFrame([(at(8, 4), at(9, 0)), (at(8, 5), at(9, 0))], "a timestamp, b timestamp")
    assert [r[0] for r in df.select(results.next_daily_reset(A)).orderBy("a").collect()] == [at(8, 5), dt.datetime(2024, 5, 2, 8, 5)]
    when = lambda s, waited: df.limit(1).select(scheduling.resume_time(F.lit(s), A, B, F.lit(waited), F.lit(False))).first()[0]
    assert when("waiting daily", False) == at(9, 0) and when("waiting daily", True) == at(8, 34) and when("waiting retry", False) == at(8, 19) and when("waiting busy", False) == at(9, 0) and when("running", False) is None
    assert one(spark, ct.resume_due(A, F.lit(False), B, F.to_timestamp(F.lit("2024-05-01 10:00:00"))), a="waiting", b="2024-05-01 09:00:00") and not one(spark, ct.resume_due(A, F.lit(False), B, F.to_timestamp(F.lit("2024-05-01 10:00:00"))), a="waiting", b="2024-05-01 11:00:00")
    assert one(spark, ct.resume_due(A, F.lit(False), B, F.current_timestamp()), a="waiting", b="no time") and not one(spark, ct.resume_due(A, F.lit(True), B, F.current_timestamp()), a="running", b="no time")
    xml = spark.createDataFrame([("<urlset><url><loc>https://a.org/x</loc></url><url><loc><![CDATA[https://a.org/y]]></loc></url></urlset>",)], "xml string")
    assert sorted(r["url"] for r in importing.sitemap_urls(xml).collect()) == ["https://a.org/x", "https://a.org/y"]
    cells = spark.createDataFrame([(["Grammar School North", "University of Graz", "x"],), (["a", "b", "Grammar School North"],)], "a array<string>")
    assert [r[0] for r in cells.select(importing.blank_header(A)).collect()] == [True, False]
