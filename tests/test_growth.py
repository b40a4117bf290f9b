"""Work that must follow the input: rows that plans make on tables of frequent words, copies and chains."""

import random
import re

from pyspark.sql import functions as F

from tidewell.functions import contacts as ct
from tidewell.functions import keys
from tidewell.functions import text as tx
from tidewell.operators import allocation, extraction, inboxes, resolve, similar, verification


def most_rows(df):
    """The rows of a query, and the most that any node of its plan put out."""
    rows = df.collect()

    def walk(node):
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            yield from walk(node.executedPlan())
        elif kind.endswith("QueryStageExec"):
            yield from walk(node.plan())
        else:
            rows_out = node.metrics().get("numOutputRows")
            if rows_out.isDefined():
                yield rows_out.get().value()
            for i in range(node.children().size()):
                yield from walk(node.children().apply(i))

    return rows, max(walk(df._jdf.queryExecution().executedPlan()))


def test_register_best_meets_no_square_of_frequent_words_and_copies(spark):
    rnd = random.Random(3)
    kinds = [sorted(rnd.sample([f"w{k:02d}" for k in range(30)], 4)) for _ in range(300)]
    names = [(k, kinds[k % 300], "02") for k in range(1200)]
    register = [(k, "MI", kinds[k % 300], [], kinds[k % 300], False) for k in range(1200)]
    got, most = most_rows(similar.register_best(
        spark.createDataFrame(names, "name_id int, words array<string>, area string"),
        spark.createDataFrame(register, "code int, sig string, names array<string>, towns array<string>, label array<string>, private boolean"),
        spark.createDataFrame([("02", "MI")], "prefix string, sig string"),
    ))
    assert len(got) == 1200 and all(r["ambiguous"] and kinds[r["code"]] == kinds[r["name_id"] % 300] for r in got)
    assert most < 20_000


def test_town_match_meets_equal_names_and_groups_once(spark):
    words = ["alpha", "beta", "town"]
    names = spark.createDataFrame([(k, "c", words) for k in range(500)] + [(900, "c", ["gamma", "town"])], "name_id int, country string, words array<string>")
    register = spark.createDataFrame([(k, f"g{k}", "c", ["town"], words) for k in range(40)] + [(99, "g7", "c", ["town"], ["gamma", "town"])], "entry_id int, grp string, country string, town array<string>, words array<string>")
    got, most = most_rows(resolve.town_match(names, register))
    assert [tuple(r) for r in got] == [(900, "g7")] and most < 2_000


def test_lead_numbers_makes_no_wish_twice(spark):
    rows = spark.createDataFrame([(1, "i", ["+49 30 000001", "+49 30 000002"]), (2, "i", ["+49 30 000001"])], "row int, institute string, numbers array<string>")
    people = spark.createDataFrame([(1, 1, "+49 30 000003"), (2, 0, "+49 30 000003"), (2, 1, "+49 30 000004")], "row int, person int, phone string")
    out = allocation.lead_numbers(rows, people, spark.createDataFrame([], "institute string, hash string"), "row")
    assert sorted((r["row"], r["person"], r["number"][-1]) for r in out.collect()) == [(1, 0, "1"), (1, 0, "2"), (1, 1, "3"), (2, 1, "4")]
    assert "Join" not in out._jdf.queryExecution().optimizedPlan().toString()


def counting(monkeypatch):
    """How many rows each table has that the allocation writes for its rounds."""
    put, many = allocation.written, []

    def seen(df, tag):
        out = put(df, tag)
        if tag == "wishes":
            many.append(out.count())
        return out

    monkeypatch.setattr(allocation, "written", seen)
    return many


def test_lead_numbers_keep_wishes_for_numbers_long_gone_off_the_disk(spark, monkeypatch):
    many = counting(monkeypatch)
    number = lambda k: f"+49 30 {k % 40:06d}"
    rows = [(k, "i", [number(7 * k + j) for j in range(5)]) for k in range(2000)]
    people = [(k, p, number(k + p)) for k in range(2000) for p in range(3)]
    out = allocation.lead_numbers(spark.createDataFrame(rows, "row int, institute string, numbers array<string>"), spark.createDataFrame(people, "row int, person int, phone string"), spark.createDataFrame([], "institute string, hash string"), "row")
    assert sorted(r["number"] for r in out.collect()) == [number(k) for k in range(40)]
    assert many[0] < 2000 and sum(many) < 3000  # of 16,000 wishes


def test_wishes_fall_once_an_earlier_agent_surely_takes_the_item(spark, monkeypatch):
    many = counting(monkeypatch)
    wants = spark.createDataFrame([(a, p, p, 2) for a in range(200) for p in range(6)], "agent int, place int, item int, cap int")
    got = allocation.allocate_once(wants, "agent", "place", "item", "cap")
    assert sorted((r["agent"], r["item"]) for r in got.collect()) == [(k // 2, k) for k in range(6)]
    assert many[0] == 1200 and many[1] < 820  # all wished for 0 and 1, that the first of all takes, fell at once


def test_lead_numbers_hold_where_keys_repeat_and_every_row_tells(spark, monkeypatch):
    monkeypatch.setattr(allocation, "TELLING", 1, raising=False)
    number = lambda k: f"+49 30 {k:06d}"
    people = spark.createDataFrame([(1, 1, number(1)), (1, 1, number(2)), (2, 1, number(2)), (3, 1, number(1)), (3, 2, number(3))], "row int, person int, phone string")
    rows = spark.createDataFrame([(k, None if k == 2 else "i", []) for k in (1, 2, 3)], "row int, institute string, numbers array<string>")
    tried = spark.createDataFrame([("i", number(3)), (None, number(2))], "institute string, phone string").select("institute", keys.phone_hash(F.col("phone")).alias("hash"))
    got = allocation.lead_numbers(rows, people, tried, "row")
    # a lead named twice takes one number, so that the other is still there; nobody's tries are nobody's
    assert sorted((r["row"], r["person"], r["number"][-1]) for r in got.collect()) == [(1, 1, "1"), (2, 1, "2")]


def test_role_gate_and_stems_lose_nothing():
    said = ["erasmus+ officer", "head of the international", "vice rector for international", "geschaftsfuhrer", "gerant", "proprietaire", "head master", "co-founder", "projektleiter", "ingles docente", "secretar", "mobility manager", "auslandsamt", "faculte x erasmus"]
    for x in said:
        assert re.search(ct.ANY_ROLE, x) and re.search(ct.ROLE_GATE, x), x
    rnd = random.Random(1)
    for stem in ct.ROLE_STEMS:
        for x in (stem, f"a{stem}b", stem[:-1], stem[1:], stem + rnd.choice(ct.ROLE_STEMS)):
            assert bool(re.search("|".join(ct.ROLE_STEMS), x)) == bool(re.search(ct.ANY_STEM, x)), x


def test_contact_notes_judges_once_and_sends_no_text_on(spark):
    who = spark.createDataFrame([(k, "Eva Lang", "eva@g.at", "", f"http://g.at/{k % 3}", "Eva Lang", "http://g.at/1", "g.at") for k in range(9)], "id int, name string, email string, phone string, source_url string, evidence_quote string, email_source_url string, official string")
    pages = spark.createDataFrame([(f"http://g.at/{k}", f"Eva  Lang {k}" + " eva@g.at" * (k > 0), False) for k in range(3)], "url string, text string, uncertified boolean")
    out = verification.contact_notes(who, pages, "id")
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("quote not on page") == 1 and len(re.findall(r"locate\(", plan)) <= 2
    assert {r["id"]: r["verified"] for r in out.collect()} == {k: True for k in range(9)}


def test_addresses_by_runs_are_those_of_the_plain_pattern(spark):
    rnd = random.Random(5)
    said = ["".join(rnd.choice(["a", "b.", "-", "_", "@a", "@", ".b", " ", "%", "<"]) for _ in range(rnd.randint(0, 40))) for _ in range(3000)] + ["a@b.com_x@y.com z@q", "a" * 30_000, "x@y.z@u.v.w", ""]
    df = spark.createDataFrame([(x,) for x in said], "x string")
    found = lambda p: F.regexp_extract_all("x", F.lit(f"({p})"), F.lit(1))
    got = df.select(found(tx.EMAIL).alias("a"), found(tx.EMAIL_ONCE).alias("b")).collect()
    assert all(r["a"] == r["b"] for r in got) and sum(len(r["a"]) for r in got) > 300


def test_pieces_that_stand_letter_for_letter_change_no_verdict(spark):
    rnd = random.Random(6)
    mixed = lambda n: "".join(rnd.choice("aAéÉΣσ ß \n “'́İ.") for _ in range(rnd.randint(0, n)))
    rows = [("ΟΔΟΣ", "ΟΔΟΣΑ"), ("ΟΔΟΣΑ", "ΟΔΟΣΑ"), ("a...b", "a...b"), ("ab", "ab"), ("  ab ", "x  ab y")]
    for _ in range(1500):
        t = mixed(30)
        k = rnd.randint(0, len(t))
        rows.append((rnd.choice([t[k : k + rnd.randint(0, 9)], mixed(4)]), t))
    df = spark.createDataFrame(rows, "p string, t string")
    plain = F.contains(keys.comparable(F.col("t")), keys.comparable(F.col("p")))
    slow = F.size(F.split("p", r"\.\.\.")) == 1
    long = F.char_length(keys.comparable(F.col("p"))) >= 3
    wide = F.btrim(F.regexp_replace(F.replace(F.translate(keys.fold(F.col("t")), "“ ", '" '), F.lit("ß"), F.lit("ss")), r"\s+", " "))
    got = df.select("p", "t", plain.alias("a"), tx.comparable_in(F.col("p"), F.col("t")).alias("b"), (slow & long & plain).alias("c"), tx.quote_in_text(F.col("p"), F.col("t")).alias("d"), slow.alias("s"), (keys.comparable(F.col("t")) == wide).alias("k"), F.contains(F.lower("t"), F.lower(F.btrim("p"))).alias("e"), tx.email_in_text(F.col("p"), F.col("t")).alias("f")).collect()
    for r in got:
        assert r["k"] and r["a"] == r["b"] and (not r["s"] or r["c"] == r["d"]) and (r["p"].strip(" ") == "" or r["e"] == r["f"]), r


def joined_columns(node):
    """Names of the columns that any join of a plan is given."""
    kids = [node.children().apply(i) for i in range(node.children().size())]
    own = {k.output().apply(i).name() for k in kids for i in range(k.output().size())} if node.nodeName() == "Join" else set()
    return own.union(*map(joined_columns, kids))


def test_shared_inboxes_joins_no_text(spark):
    pages = spark.createDataFrame([("a", 0, "https://a.org/", "Site by x@studio.org\nwrite to school.a@gmail.com"), ("a", 1, "https://a.org/contact", "Design: maker.a@gmail.com maker.a@gmail.com")], "entity string, i int, url string, text string")
    sites = spark.createDataFrame([("a", "https://a.org/", "Some Name")], "entity string, site string, name string")
    out = inboxes.shared_inboxes(pages, sites, "entity")
    assert [tuple(r) for r in out.collect()] == [("a", "school.a@gmail.com", "https://a.org/", 3)]
    joined = joined_columns(out._jdf.queryExecution().optimizedPlan())
    assert "email" in joined and "text" not in joined


def test_page_emails_are_those_of_the_plain_patterns(spark):
    rnd = random.Random(8)
    parts = ["a", "b.c", "@x.org", "@", " ", "\n", "\t", "<", ">", " [at] ", "(dot)", "{ AT }", "( . )", "(", "]", "?", "%20", ".;", "Info", "x.deFax"]
    said = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 14))) for _ in range(2500)]
    df = spark.createDataFrame([(x,) for x in [*said, None]], "x string")
    x = F.col("x")
    all_of = lambda t: F.transform(F.regexp_extract_all(t, F.lit(f"({tx.EMAIL})"), F.lit(1)), tx.repaired_email)
    marked = lambda t: F.transform(F.regexp_extract_all(t, F.lit(r"<([^<>\s@]+@[^<>\s]+)>"), F.lit(1)), lambda e: F.regexp_replace(e, "[.,;:]+$", ""))
    either = lambda t: F.array_distinct(F.when(F.size(marked(t)) > 0, marked(t)).otherwise(all_of(t)))
    plain = F.regexp_replace(F.regexp_replace(x, r"(?i)\s*[\[({]\s*(?:at|@|arroba|chez)\s*[\])}]\s*", "@"), r"(?i)\s*[\[({]\s*(?:dot|punkt|point|punto|\.)\s*[\])}]\s*", ".")
    bare = F.transform(F.concat(either(plain), all_of(plain)), lambda e: F.lower(F.regexp_replace(F.substring_index(e, "?", 1), "^(?:%20)+", "")))
    slow = F.array_distinct(F.filter(bare, lambda e: F.contains(e, F.lit("@"))))
    got = df.select("x", either(x).alias("a"), tx.emails_in(x).alias("b"), slow.alias("c"), ct.page_emails(x).alias("d")).collect()
    for r in got:
        assert r["a"] == r["b"] and r["c"] == r["d"], r
    assert sum(len(r["d"] or []) for r in got) > 300


def test_rules_partners_reads_lines_once_and_joins_no_pairs(spark):
    said = ["Our Partners", "School A1", "School B2", "x", "School C3", "Erasmus network", "University D4", "COLLEGE E5", "ÉCOLE F6", "école g7 institut"]
    lines = spark.createDataFrame([("a", 0, k + 190, x) for k, x in enumerate(said)], "entity string, page int, n int, line string")
    own = spark.createDataFrame([("a", ["nothing"])], "entity string, tokens array<string>")
    out = extraction.rules_partners(lines, own, "entity")
    assert sorted((r["n"], r["name"]) for r in out.collect()) == [(190 + k, said[k]) for k in (1, 2, 4, 6, 7, 9)]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 1 and "Inner" not in plan


def test_pieces_find_what_their_patterns_find(spark):
    rnd = random.Random(9)
    words = [w.strip("\\b") for _, p in extraction.KINDS for w in p.split("|")] + extraction.PARTNER_HEADING[4:].split("|") + extraction.INSTITUTION[4:].split("|")
    case = lambda w: rnd.choice([w, w.upper(), w.title(), w[1:], w.replace("k", "K").replace("i", "İ")])
    rows = [(" ".join(case(rnd.choice([*words, "x", "movies", "ies"])) for _ in range(rnd.randint(0, 2))),) for _ in range(2000)]
    x = F.col("x")
    patterns = [extraction.PARTNER_HEADING, extraction.INSTITUTION, *[p for _, p in extraction.KINDS]]
    got = spark.createDataFrame([*rows, (None,)], "x string").select("x", F.array(*[x.rlike(p) for p in patterns]).alias("a"), F.array(*[extraction.has_piece(x, p) for p in patterns]).alias("b")).collect()
    for r in got:
        assert r["a"] == r["b"], r
    assert all(0 < sum(bool(r["a"][k]) for r in got) < len(got) for k in range(4))
