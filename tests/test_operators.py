import datetime as dt

from pyspark.sql import functions as F

from tidewell.operators import calls, evidence, matching, scheduling
from tidewell.sources import tables
from tidewell.streaming import monitors

AT = lambda s: dt.datetime.fromisoformat(f"2024-05-0{s}")


def test_gap_arithmetic(spark):
    rows = [(1, "7", AT("1T09:07:08"), 0.0), (2, "7", AT("1T09:08:04"), 241.0), (3, "7", AT("1T09:15:55"), 0.0), (4, "8", AT("1T09:00:00"), 0.0)]
    df = spark.createDataFrame(rows, "call_id long, extension string, start timestamp_ntz, seconds double")
    assert [(r["call_id"], r["gap_seconds"]) for r in calls.call_gaps(df, 1).collect()] == [(3, 230.0)]


def test_summary_with_open_logout(spark):
    alerts = spark.createDataFrame([("d", "a", "offline", None), ("d", "a", "gap", 31.3), ("d", "a", "gap", 62.0)], "day string, who string, kind string, minutes double")
    outs = spark.createDataFrame([("d", "a", 29.0), ("d", "a", None), ("d", "b", None)], "day string, who string, minutes double")
    got = {r["who"]: r for r in calls.daily_summary(alerts, outs).collect()}
    assert (got["a"]["offline"], got["a"]["gaps"], got["a"]["longest_text"], got["a"]["lost_text"], got["a"]["away_text"]) == (1, 2, "1 h 02 min", "1 h 33 min", "29 min + still out")
    assert got["b"]["away_text"] == "still out" and got["b"]["gaps"] == 0


def test_duplicate_groups_are_not_transitive(spark):
    rows = spark.createDataFrame([(1, "p", "x"), (2, "p", "y"), (3, "q", "y"), (4, "", None), (5, None, "")], "id long, phone string, name string")
    assert {r["id"]: r["groups"] for r in matching.duplicate_groups(rows, "id", ["phone", "name"]).collect()} == {1: ["1.1"], 2: ["1.1", "2.1"], 3: ["2.1"]}


def test_number_is_used_up_only_when_taken(spark):
    rows = [("s", 1, k, n) for k, n in enumerate(["a", "b", "c", "d"])] + [("s", 2, 0, "d"), ("s", 2, 1, "a")]
    df = spark.createDataFrame(rows, "shard string, lead long, place long, number string")
    got = scheduling.numbers_once(df, "shard", "lead", "place", "number").collect()
    assert sorted((r["lead"], r["number"]) for r in got) == [(1, "a"), (1, "b"), (1, "c"), (2, "d")]


def test_evidence_budget(spark):
    pages = spark.createDataFrame([("e", "p1", 2, "aaaa\nBBBB\ncccc"), ("e", "p2", 1, "bbbb\ndddddddddd\nee\nffff")], "ent string, url string, score int, text string")
    lines = evidence.numbered_lines(pages, "ent", "url", "score")
    assert [r["line"] for r in lines.orderBy("n").collect()] == ["aaaa", "BBBB", "cccc", "dddddddddd", "ffff"]
    kept = evidence.within_budget(lines, "ent", "url", "score", budget=40, least=10)
    assert sorted(r["line"] for r in kept.collect()) == ["aaaa", "dddddddddd"]


def test_never_worse_and_reuse(spark):
    old = spark.createDataFrame([(1, "a", 5), (2, None, 3)], "k long, c string, n long")
    new = spark.createDataFrame([(1, None, 2), (2, "b", 1), (3, "c", 0)], "k long, c string, n long")
    assert sorted(tuple(r) for r in matching.never_worse(old, new, "k", "c", "n").collect()) == [(1, "a", 5, False), (2, "b", 3, True), (3, "c", 0, True)]
    df = spark.createDataFrame([(None, True, True, True), (False, True, True, True), (None, True, False, True)], "now boolean, b boolean, v boolean, s boolean")
    assert [r[0] for r in df.select(matching.reuse_verified(F.col("now"), F.col("b"), F.col("v"), F.col("s"))).collect()] == [True, False, None]


def test_sheets(spark, tmp_path):
    path = str(tmp_path / "s.csv")
    with open(path, "w", encoding="utf-8-sig") as f:
        f.write('Name of Institution,E-Mail\n"A\nB",x@y.z\n,"q ""r"""\n')
    df = tables.read_sheet(spark, path)
    got = tables.rename_by_aliases(df, {"name": ["institution", "name of institution"], "email": ["email", "e mail"], "phone": ["phone"]}, "name")
    assert [tuple(r) for r in got.collect()] == [("A\nB", "x@y.z", None), (None, 'q "r"', None)]
    assert tables.read_sheet(spark, str(tmp_path / "none.csv"), ["a"]).columns == ["a"]


def polls(spark):
    rows = [(e, AT(f"1T{9 + k // 4:02d}:{15 * (k % 4):02d}:00"), None if k % 7 == 3 else (k * (e + 2)) % 5 != 0) for e in range(3) for k in range(30)]
    return spark.createDataFrame(rows, "extension long, at timestamp, online boolean")


def test_stream_equals_batch(spark, tmp_path):
    df = polls(spark)
    for k in range(3):
        df.filter(F.hour("at").between(9 + 3 * k, 11 + 3 * k)).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    q = monitors.presence_alerts(stream).writeStream.format("memory").queryName("alerts").outputMode("append").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    got = sorted(tuple(r) for r in spark.table("alerts").collect())
    want = sorted(tuple(r) for r in monitors.presence_alerts_batch(df).collect())
    assert got == want and want


def test_quiet_time_and_idle():
    s, r = monitors.presence_step((None, None, None), 0.0, True, True, 900, 3600)
    assert r is None
    s, r = monitors.presence_step(s, 900.0, True, True, 900, 3600)
    assert r == "no activity change"
    s, r = monitors.presence_step(s, 1000.0, False, True, 900, 3600)
    assert r is None
    assert monitors.presence_step(s, 4500.0, False, True, 900, 3600)[1] == "offline during shift"
    s, r = monitors.presence_step(s, 5000.0, None, True, 900, 3600)
    assert (s, r) == ((None, 900.0, 900.0), None)
    assert monitors.presence_step(s, 9000.0, True, True, 900, 3600)[1] is None  # after an unanswered poll, online is not idle


def test_groups_with_one_least_row_are_two(spark):
    rows = spark.createDataFrame([(1, "a", "x"), (2, "a", ""), (3, "", "x")], "id long, phone string, name string")
    got = {r["id"]: set(r["groups"]) for r in matching.duplicate_groups(rows, "id", ["phone", "name"]).collect()}
    assert got[1] == {"1.1", "1.2"} == got[2] | got[3] and not got[2] & got[3]


def test_pause_wins_over_progress(spark):
    from pyspark.sql import functions as F

    from tidewell.operators import scheduling

    cases = [((0, False, "quota"), "done"), ((3, True, "quota"), "waiting daily"), ((3, True, "busy"), "waiting busy"), ((3, True, None), "running"), ((3, False, None), "waiting retry"), ((3, None, None), "waiting retry")]
    df = spark.createDataFrame([(i, *c) for i, (c, _) in enumerate(cases)], "i int, p int, g boolean, r string")
    got = {r[0]: r[1] for r in df.select("i", scheduling.wait_state(F.col("p"), F.col("g"), F.col("r"))).collect()}
    assert [got[i] for i in range(len(cases))] == [want for _, want in cases]


def test_parts_follow_the_order(spark):
    from tidewell.operators import importing

    rows = spark.range(5000).selectExpr("(id * 7919) % 5000 * 3 AS k")
    got = sorted((r["k"], r["part"]) for r in importing.parts(rows, "k").collect())
    assert [p for _, p in got] == [i // 1000 + 1 for i in range(5000)]
    assert {r["part"] for r in importing.parts(rows.limit(1200), "k").collect()} == {1}


def test_numbers_once_per_shard(spark):
    from tidewell.operators import scheduling

    rows = [("a", 1, 1, "n1"), ("a", 1, 2, "n2"), ("a", 1, 3, "n3"), ("a", 1, 4, "n4"), ("a", 2, 1, "n4"), ("a", 2, 2, "n1"), ("b", 1, 1, "n1"), ("b", 1, 2, None)]
    got = scheduling.numbers_once(spark.createDataFrame(rows, "s string, lead int, o int, n string"), "s", "lead", "o", "n").collect()
    assert sorted(tuple(r) for r in got) == [("a", 1, 1, "n1"), ("a", 1, 2, "n2"), ("a", 1, 3, "n3"), ("a", 2, 1, "n4"), ("b", 1, 1, "n1")]


def test_links_of_any_anchor(spark):
    from pyspark.sql import functions as F

    from tidewell.functions import pages

    html = '<A class=x HREF="/a?b=1&amp;c">One <b>two</b></A> <a href=\'c.html\'>C</a><a href=../d>D</a><a href="https://e.org/">E</a><a href="/a?b=1&amp;c">again</a><a href="#top">no</a><a href="mailto:x@y.org">m</a><a href=//f.org>F</a>'
    got = spark.range(1).select(pages.links(F.lit(html), F.lit("http://h.org/p/q.html?z#w")).alias("l")).first()["l"]
    assert [tuple(x) for x in got] == [("One two", "http://h.org/a?b=1&c"), ("C", "http://h.org/p/c.html"), ("D", "http://h.org/p/../d"), ("E", "https://e.org/"), ("F", "http://f.org")]
    text = spark.range(1).select(pages.page_text(F.lit("<nav>menu</nav><p>Write <a href='mailto:a@b.org?subject=x'>us</a><script>x</script></p><table><tr><td>1</td><td>2</td></tr></table>"))).first()[0]
    assert text == "Write us <a@b.org>\n1 | 2 |"
