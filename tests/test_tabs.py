"""Shared inboxes and tabs of a workbook."""

from tidewell.operators import inboxes, workbook


def test_shared_inboxes(spark):
    pages = [
        ("a", 0, "https://www.branly.fr/", "ce.0941018w@ac-creteil.fr\ncontact@branly.fr"), ("a", 1, "https://www.branly.fr/x", "erasmus@branly.fr marie@branly.fr"), ("b", 0, "https://b.org/", "webmaster@b.org Site by studio@agency.com"),
        ("c", 0, "https://florida.es/", "info@florida-uni.es insa@insa-toulouse.fr"), ("d", 0, "https://d.org/", "school.d@gmail.com"), ("d", 1, "https://d.org/news", "other@gmail.com"), ("e", 1, "https://e.org/news", "e@gmail.com you@wixpress.com"),
        ("f", 0, "https://accademiadibrera.milano.it/", "accademia@accademiadibrera.milano.it sales@accademiadibrera.milano.it"), ("g", 0, "https://g.org/", "x@g.org y@g.org"), ("g", 1, "https://g.org/2", "y@g.org"), ("h", 0, "https://h.org/", None),
    ]
    df = spark.createDataFrame(pages, "entity string, i int, url string, text string")
    sites = spark.createDataFrame([(e, u, "Some Name") for e, i, u, _ in pages if i == 0] + [("e", "https://e.org", None)], "entity string, site string, name string")
    got = {r["entity"]: (r["email"], r["tier"]) for r in inboxes.shared_inboxes(df, sites, "entity").collect()}
    assert got == {"a": ("erasmus@branly.fr", 0), "c": ("info@florida-uni.es", 3), "d": ("school.d@gmail.com", 3), "f": ("accademia@accademiadibrera.milano.it", 1), "g": ("y@g.org", 2)}


def test_columns_and_titles(spark):
    df = spark.createDataFrame([(1, 2, 3)], "row_id int, partner_name int, x int")
    assert workbook.reordered(df, ["x", "gone", "row_id"]).columns == ["x", "row_id", "partner_name"]
    assert workbook.reordered(df, ["x"], {"x": "Rank"}).columns == ["Rank", "Row Id", "Partner Name"]
    rows = [("r001", 1, "Graz [School]: 'A'"), ("r002", 2, None), ("r1", 3, "x" * 40), ("R1", 4, "X" * 40), ("Part", 5, "ners")]
    got = {r["row_id"]: r["title"] for r in workbook.tab_titles(spark.createDataFrame(rows, "row_id string, n int, name string"), "row_id", "name", "n", ["Partners", "r002"]).collect()}
    assert got["r001"] == "r001 Graz School A" and got["r1"] == "r1 " + "x" * 28 and got["Part"] == "Part ners"
    assert got["R1"] == ("R1 " + "X" * 40)[:27] + " R1" and got["r002"] == "r002"[:27] + " 002"
    assert len({t.lower() for t in got.values()}) == 5


def test_institution_tabs(spark):
    inst = spark.createDataFrame([("r1", 1, "Graz"), ("r2", 2, "Linz"), ("r3", 3, "Wien")], "row_id string, n int, name string")
    partners = spark.createDataFrame([("r1", 2, "B", "FR"), ("r1", 1, "A", None), ("r3", 1, "C", "DE")], "row_id string, n int, partner string, country string")
    campuses = spark.createDataFrame([("r3", 1, "North")], "row_id string, n int, campus string")
    sections = [("Partners ({n})", partners, [("partner", "Partner"), ("country", "Country")]), ("Campuses ({n})", campuses, [("campus", "Campus"), ("", "")])]
    got = {}
    for r in workbook.institution_tabs(inst, sections, "row_id", "name", "n", []).orderBy("title", "line").collect():
        got.setdefault(r["title"], []).append(list(r["cells"]))
    assert set(got) == {"r1 Graz", "r3 Wien"}
    assert got["r1 Graz"] == [["Graz", ""], ["Back to all institutes", ""], ["", ""], ["Partners (2)", ""], ["Partner", "Country"], ["A", ""], ["B", "FR"]]
    assert got["r3 Wien"] == [["Wien", ""], ["Back to all institutes", ""], ["", ""], ["Partners (1)", ""], ["Partner", "Country"], ["C", "DE"], ["", ""], ["Campuses (1)", ""], ["Campus", ""], ["North", ""]]
