import pytest
from pyspark.sql import functions as F

from tidewell.functions import contacts as c
from tidewell.functions import phones as ph
from tidewell.operators import importing as im

from .test_functions import one

A = B = C = None


@pytest.fixture(autouse=True)
def columns(spark):
    """Columns need a running session."""
    globals().update(A=F.col("a"), B=F.col("b"), C=F.col("c"))


def test_emails_and_phones(spark):
    assert one(spark, c.repaired_email(A), a="x@y.comTel") == "x@y.com" and one(spark, c.repaired_email(A), a="x@y.community.org") == "x@y.community.org"
    assert one(spark, c.page_emails(A), a="Me(at)x.org, me [at] x [dot] org; ME@x.org?subject=hi") == ["me@x.org"]
    assert one(spark, ph.phone_trust(A, B, F.lit(False), F.lit(False), F.lit("IT")), a="021 432 6100", b="Tel: 021 432 6100") == 2
    assert one(spark, c.own_email_strict(A, B), a="j.smith@x.org", b="Jane Smith") and one(spark, c.own_email_strict(A, B), a="jsmith@x.org", b="Jane Smith")
    assert not one(spark, c.own_email_strict(A, B), a="info@x.org", b="Jane Smith") and not one(spark, c.own_email_strict(A, B), a="smithson@x.org", b="Jane Smith")
    df = spark.createDataFrame([("Jane Smith", ["info@x.org", "smith@x.org"]), ("Jo Do", ["a@b.c", "d@e.f"]), ("Jo Do", ["a@b.c"])], "a string, b array<string>")
    assert [r[0] for r in df.select(c.pick_email(A, B)).collect()] == ["smith@x.org", None, "a@b.c"]
    assert one(spark, c.inbox_tier(A, B, F.lit(False)), a="info@x.org", b="x.org") == 1 and one(spark, c.inbox_tier(A, B, F.lit(False)), a="a@z.org", b="x.org") == 3


def test_people_and_roles(spark):
    assert one(spark, c.looks_like_person(A), a="Dr. Jana van der Berg") and not one(spark, c.looks_like_person(A), a="jana berg")
    assert one(spark, c.role_of(A), a="Erasmus+ Coordinator") == "institutional_erasmus_coordinator" and one(spark, c.role_of(A), a="Directeur") == "principal_or_director" and one(spark, c.role_of(A), a="cook") is None
    assert one(spark, c.person_from_title(A), a="Prof. Jana Berg - Some School") == "Jana Berg"
    assert one(spark, c.partner_line_ok(A, B), a="Universität Graz", b="with Graz since 1990") and not one(spark, c.partner_line_ok(A, B), a="Universität Graz", b="with Linz")
    assert one(spark, c.name_in_domain(A, B), a="www.musterschule.de", b="Musterschule Köln") and one(spark, c.name_in_domain(A, B), a="abc.org", b="ABC")
    assert one(spark, c.country_named(A, B), a="Österreich", b="Wien, Osterreich") and not one(spark, c.country_named(A, B), a="unknown", b="unknown")


def test_links_and_results(spark):
    score = c.link_score(A, B, {"contact": 5.0, "staff": 3.0}, "login")
    assert one(spark, score, a="Contact", b="http://x.org/contact.pdf") == 17.0 and one(spark, score, a="Staff", b="http://x.org/2019/") == -2.0 and one(spark, score, a="Contact login", b="http://x.org") == 0.0
    assert one(spark, c.coverage_text(A, B, C), a=3, b=2, c=9) == "2 verified of ~9 stated (rest of the list not readable)" and one(spark, c.coverage_text(A, B, C), a=3, b=2, c=1) == "2 of 3 verified"
    got = one(spark, c.alert_reason(A), a="1h02m00s gap between calls (previous ended around 2024-05-01 09:07:08, next started 2024-05-01 10:09:08)")
    assert tuple(got) == ("gap", 62.0, "2024-05-01", "09:07") and one(spark, c.alert_reason(A), a="x offline during shift")["kind"] == "offline"
    m = c.result_metrics(A, F.lit(None).cast("string"), B, F.lit(""), C, F.lit(True))
    row = spark.createDataFrame([("Jo", "info@x", "ok"), (None, None, "ok"), (None, "i@x", "Website not found by search")], "a string, b string, c string").select(*[v.alias(k) for k, v in m.items()]).collect()
    assert [(r["contact_generic"], r["website_dead"], r["no_website"], r["reachable"]) for r in row] == [(1, 0, 0, 1), (0, 1, 0, 0), (0, 0, 1, 0)]
    assert one(spark, c.template_fill(A, {"n": B}), a="Hi {{n}}!", b="Jo") == "Hi Jo!"
    with pytest.raises(Exception, match="unfilled"):
        one(spark, c.template_fill(A, {"n": B}), a="Hi {{m}}!", b="Jo")
    assert one(spark, c.change_list({"x": (A, B)}), a="A-b", b="ab") == [] and one(spark, c.site_root(A), a="http://www.x.org/y") == "http://x.org/"


def test_importing(spark):
    df = spark.createDataFrame([(1, "A\nB\nC", "1\n2\n3", "z"), (2, "D", "x@y\nz@w", None), (3, "E\nF", "1\n2\n3", "")], "id int, name string, mail string, phone string")
    got = sorted(tuple(r) for r in im.expand_merged(df, "name", ["mail", "phone"]).select("id", "name", "mail", "phone", "split").collect())
    assert got == [(1, "A", "1", "z", True), (1, "B", "2", "z", True), (1, "C", "3", "z", True), (2, "D", "x@y; z@w", "", False), (3, "E", "1", "", True), (3, "F", "2", "", True)]
    sheet = spark.createDataFrame([(r, k, v) for r in range(5) for k, v in enumerate([str(r), "Grammar School %d North" % r, "some free text", "http://x"])], "row int, col int, cell string")
    assert im.guess_name_column(sheet, "school").orderBy("place").first()["col"] == 1
    big = im.parts(spark.range(2500), "id").groupBy("part").count().orderBy("part").collect()
    assert [tuple(r) for r in big] == [(1, 1000), (2, 1000), (3, 500)] and im.parts(spark.range(1200), "id").select("part").distinct().collect()[0][0] == 1
    cells = spark.createDataFrame([("g", 1, "a"), ("g", 2, ""), ("g", 3, "b")], "g string, o int, v string")
    assert [r["v"] for r in im.inherit_down(cells, "g", ["o"], ["v"]).orderBy("o").collect()] == ["a", "a", "b"]
    old, new = spark.createDataFrame([(1, "", "k")], "k int, a string, b string"), spark.createDataFrame([(1, "n", "o")], "k int, a string, b string")
    assert tuple(im.fill_blanks(old, new, "k", ["a", "b"]).first()) == (1, "n", "k", 1)


def test_list_runs(spark):
    text = ["Partners", "U one", "U two", "noise", "U three", *["x"] * 8, "U four", "Partners", "U five", "x"]
    df = spark.createDataFrame([("e", "p", k, t) for k, t in enumerate(text)], "entity string, page string, n int, t string")
    got = im.list_runs(df, "entity", F.col("t") == "Partners", F.col("t").startswith("U "))
    assert [r["t"] for r in got.orderBy("n").collect()] == ["U one", "U two", "U three"]


def test_own_domain_refuses_siblings(spark):
    cases = [("a@uni.edu", "www.uni.edu", True), ("a@lab.uni.edu", "uni.edu", True), ("a@uni.edu", "lab.uni.edu", True), ("a@x.uni.edu", "y.uni.edu", False), ("a@edu", "uni.edu", False)]
    df = spark.createDataFrame([(i, e, h) for i, (e, h, _) in enumerate(cases)], "i int, e string, h string")
    got = {r[0]: r[1] for r in df.select("i", c.own_email_domain(F.col("e"), F.col("h"))).collect()}
    assert [got[i] for i in range(len(cases))] == [w for *_, w in cases]


def test_marked_addresses_go_first(spark):
    from tidewell.functions.text import emails_in

    assert one(spark, emails_in(A), a="x@y.com or <info@z.org>.") == ["info@z.org"]
    assert one(spark, emails_in(A), a="a@b.comTel c@d.org, a@b.com") == ["a@b.com", "c@d.org"]


def test_role_classes_are_whole(spark):
    for text, role in [("English teacher", "language_or_project_teacher"), ("EU projects coordinator", "language_or_project_teacher"), ("Gérant", "principal_or_director"), ("jefe de relaciones", "international_relations_head"), ("Secretaria", "secretary_or_admin")]:
        assert one(spark, c.role_of(A), a=text) == role
