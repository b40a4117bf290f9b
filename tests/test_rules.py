"""Operators that follow stated rules, held against slow versions of the rules in plain Python."""

import datetime as dt
import json
import random
import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from tidewell.functions import contacts as ct
from tidewell.functions import phones as ph
from tidewell.operators import allocation, extraction, pacing, resolve, results, reuse, rollups, similar

from .test_functions import one

A = B = None


@pytest.fixture(autouse=True)
def columns(spark):
    globals().update(A=F.col("a"), B=F.col("b"))


def norm(s):
    return "".join(c for c in unicodedata.normalize("NFKD", s.lower()) if not unicodedata.combining(c))


# ---- JSON in prose


def scan(text):
    start = text.find("{")
    depth, inside, escaped = 0, False, False
    for i in range(start, len(text)) if start >= 0 else ():
        c = text[i]
        if inside:
            escaped, inside = (not escaped and c == "\\"), not (c == '"' and not escaped)
        elif c == '"':
            inside = True
        elif c in "{}":
            depth += 1 if c == "{" else -1
            if depth == 0:
                return text[start : i + 1]
    return None


def test_json_object_equals_scanner(spark):
    rnd = random.Random(1)
    texts = ["".join(rnd.choice('{{}}""\\\\a b,:\n[]é') for _ in range(rnd.randrange(60))) for _ in range(3000)]
    texts += ['say {"a":{"b":{"c":{"d":1}}}} ok', 'x {"s": "}\\"{", "t": {}} {"u": 1}', "none", "", '{"open": "']
    df = spark.createDataFrame(list(enumerate(texts)), "i int, a string")
    got = {r["i"]: r["o"] for r in df.select("i", resolve.json_object(A).alias("o")).collect()}
    for i, t in enumerate(texts):
        assert got[i] == scan(t), repr(t)


def test_json_object_of_any_size(spark):
    deep = '{"a":' * 1000 + "1" + "}" * 1000
    wide = json.dumps({f"k{i}": ["v\\\"" * 3, {"n": i}] for i in range(120_000)})
    long = json.dumps({"text": "word \\ " * 700_000})
    assert len(wide) > 4_000_000 and len(long) > 5_000_000
    df = spark.createDataFrame([(k, f"before ```{t}``` after }}") for k, t in enumerate((deep, wide, long))], "i int, a string")
    got = {r["i"]: r["o"] for r in df.select("i", resolve.json_object(A).alias("o")).collect()}
    assert got[0] == deep and got[1] == wide and got[2] == long


# ---- roles, names, numbers, inboxes


def test_roles_stated_and_person_names(spark):
    said = {"Maria Borg, Owner": True, "Geschäftsführer: Hans Müller": True, "Co-founder & CEO": True, "Gérant : Paul Martin": True, "Opening hours 9-5": False, "Tarptautinių ryšių skyriaus specialistas": True, "Rob Dawson": False}
    people = {"Mgr. Marta Bačíková": True, "Fehér Józsefné": True, "Giessauf Tracey, BA": True, "Jan van der Berg": True, "Secretary Office": False, "info@poli.hu": False, "Agnes": False, "Room 12 Staff": False, "John Downer": True, "Anna Partner": True, "titkár": False}
    df = spark.createDataFrame([(k,) for k in {*said, *people}], "a string").select("a", ct.states_role(A).alias("r"), ct.looks_like_person(A).alias("p")).collect()
    assert {r["a"]: r["r"] for r in df if r["a"] in said} == said
    assert {r["a"]: r["p"] for r in df if r["a"] in people} == people


def test_normal_phone(spark):
    cases = [
        ("+39 06 123 4567", "IT", "+39061234567"), ("+33 (0)4 50 12 34 56", "FR", "+33450123456"), ("+33 0450123456", "FR", "+33450123456"), ("0033 4 50 12 34 56", "FR", "+33450123456"), ("030 123456", "DE", "+4930123456"),
        ("06 1 234 5678", "HU", "+3612345678"), ("8 612 34567", "LT", "+37061234567"), ("06 1234567", "IT", "+39061234567"), ("612 345 678", "ES", "+34612345678"), ("512 345 678", "ES", ""), ("123", "DE", ""), ("+12", "DE", ""),
        ("+123456789012345678", "DE", ""), ("2123 4567", "MT", "+35621234567"), ("12345678", "CH", "+4112345678"), ("12345678", "XX", ""), ("0033123", "FR", ""), (None, "FR", ""),
    ]
    df = spark.createDataFrame([(i, *c) for i, c in enumerate(cases)], "i int, a string, b string, want string")
    for r in df.select("*", ph.normal_phone(A, B).alias("got")).collect():
        assert r["got"] == r["want"], (r["a"], r["b"])


def test_plausible_phone(spark):
    cases = [("12/05/2021", "DE", ""), ("2019-2023", "DE", ""), ("01 02 03 04 05", "FR", ""), ("0000 0000", "MT", ""), ("01 44 55 66 77", "FR", "+33144556677"), ("+49 30 123456", "FR", ""), ("+33 1 44 55 66 77", "FR", "+33144556677"), ("0144556677", "FR", ""), ("12 34", "FR", "")]
    df = spark.createDataFrame(cases, "a string, b string, want string")
    for r in df.select("*", ph.plausible_phone(A, B).alias("got")).collect():
        assert r["got"] == r["want"], r["a"]


def test_page_phones_have_trust(spark):
    html = """<a href="tel:+33%201%2044%2055%2066%2077">call</a> <script>"telephone" : "01 40 00 00 99"</script> Fax: 01 44 55 66 78 Tel. 01 44 55 66 79, SIRET 123 456 789 00 and 01 44 55 66 80"""
    plain = "<p>Write to us or ring 01 44 55 66 81. Since 2001-2010, IBAN 12 34 56 78 90</p>"
    df = spark.createDataFrame([(1, html, "FR"), (2, plain, "FR"), (3, None, "FR"), (4, plain, "XX")], "page_id int, html string, cc string")
    got = sorted((r["page_id"], r["trust"], r["phone"]) for r in ph.page_phones(df, "page_id", "html", "cc").collect())
    assert got == [(1, 2, "+33144556679"), (1, 3, "+33140000099"), (1, 4, "+33144556677"), (2, 1, "+33144556681")]
    found = spark.createDataFrame([("s", 1, 2, "+33612345678"), ("s", 2, 2, "+33144556679"), ("s", 3, 1, "+33144556600"), ("s", 4, 1, "+33144556600"), ("t", 5, 2, "+33612345678"), ("t", 6, 2, "+33612345678"), ("t", 7, 2, "+33144556679")], "site string, n int, trust int, phone string")
    assert sorted(tuple(r) for r in ph.best_site_phone(found, "site", "n").collect()) == [("s", "+33144556679", 2), ("t", "+33612345678", 2)]


def test_page_phones_after_a_line_break(spark):
    df = spark.createDataFrame([(1, "Zu ist.\n+1 (617) 555-2870 Den.", "US"), (2, "Zu ist.+1 (617) 555-2870 Den.", "US"), (3, "hôtel 617 555 2870", "US")], "page_id int, html string, cc string")
    assert sorted((r["page_id"], r["trust"], r["phone"]) for r in ph.page_phones(df, "page_id", "html", "cc").collect()) == [(1, 1, "+16175552870"), (3, 2, "+16175552870")]


def test_pick_official(spark):
    cases = [
        (["anna@x.org", "erasmus@other.org", "office@x.org"], "www.x.org", "office@x.org"), (["erasmus@other.org"], "x.org", ""), (["ce.0941018w@ac-creteil.fr", "info@gmail.com"], "branly.fr", "ce.0941018w@ac-creteil.fr"),
        (["edu.school@gmail.com"], "x.org", ""), (["b@x.org", "a@x.org"], "x.org", "b@x.org"), ([], "x.org", ""), (["info@uni.ac.uk", "mobility@dept.uni.ac.uk"], "www.uni.ac.uk", "mobility@dept.uni.ac.uk"),
    ]
    df = spark.createDataFrame(cases, "a array<string>, b string, want string")
    for r in df.select("*", results.pick_official(A, B).alias("got")).collect():
        assert r["got"] == r["want"], r["a"]


def test_page_emails(spark):
    assert one(spark, ct.page_emails(A), a="mailto:%20programs@esmt.org?subject=hi") == ["programs@esmt.org"]
    assert one(spark, ct.page_emails(A), a="x@y.comTel or Info <INFO@z.org>") == ["info@z.org", "x@y.com"]
    assert one(spark, ct.page_emails(A), a="me (arroba) x {punto} org") == ["me@x.org"]


# ---- claims against lines


def claims(spark, rows, lines):
    packed = [("e", u, n, t) for n, (u, t) in enumerate(lines, 1)]
    df = spark.createDataFrame([("e", k, *r) for k, r in enumerate(rows)], "entity string, claim int, name string, role_class string, name_n int, role_n int, email_n int, phone_n int")
    out = resolve.resolve_contacts(df, spark.createDataFrame(packed, "entity string, page string, n int, line string"), "entity")
    return [r.asDict() for r in out.orderBy("place").collect()]


def test_resolve_contacts(spark):
    lines = [("a", "Kovács Ágnes"), ("a", "Pályazati ügyintéző"), ("a", "agnes.kovacs@a.org"), ("n", "Rob Dawson - 9 September"), ("a", "titkár"), ("a", "info@a.org")]
    got = claims(spark, [("Rob Dawson", "mobility_coordinator", 4, 4, None, None), ("titkár", "secretary_or_admin", 5, 5, 6, None), ("Kovács Ágnes", "international_relations_officer", 1, 2, 3, None)], lines)
    assert [(g["name"], g["email"], g["quote"], g["confidence"], g["place"]) for g in got] == [("Kovács Ágnes", "agnes.kovacs@a.org", "Kovács Ágnes ... Pályazati ügyintéző", 0.85, 1)]
    lines = [("i", "Dr.ssa Veronica Bonanno"), ("i", "Erasmus Students"), ("i", "veronica.bonanno@a.it"), ("n", "Rob Dawson"), ("n", "Erasmus news")]
    got = claims(spark, [("Veronica Bonanno", "mobility_coordinator", 1, 2, 3, None), ("Rob Dawson", "mobility_coordinator", 4, 5, None, None)], lines)
    assert [g["name"] for g in got] == ["Veronica Bonanno"]
    lines = [("m", "Contact the ITM Education Office (Charlotte Morantin – cmorantin@itg.be)"), ("n", "Photo: Anna Peeters")]
    got = claims(spark, [("Charlotte Morantin", "secretary_or_admin", 1, 1, 1, None), ("Anna Peeters", "other", 2, 2, None, None)], lines)
    assert [(g["name"], g["email"]) for g in got] == [("Charlotte Morantin", "cmorantin@itg.be")]
    lines = [("p", "Maria Borg - Owner"), ("p", "maria@shop.mt"), ("p", "Anna Berger"), ("p", "info@x.org"), ("p", "Our Services"), ("p", "reception"), ("p", "Carl Meier, Erasmus coordinator, +49 30 1234567")]
    rows = [("Maria Borg", "principal_or_director", 1, 1, 2, None), ("Anna Berger", "other", 3, None, 4, None), ("Our Services", "other", 5, 6, None, None), ("Carl Meier", "institutional_erasmus_coordinator", 7, None, None, 7), ("Nobody Here", "other", 99, 99, None, None)]
    got = claims(spark, rows, lines)
    assert [(g["name"], g["email"], g["phone"], g["confidence"]) for g in got] == [("Carl Meier", "", "+49 30 1234567", 0.8), ("Maria Borg", "maria@shop.mt", "", 0.6)]


def test_on_file_and_town_match(spark):
    people = spark.createDataFrame([("e", 1, "Maria Lopez", ""), ("e", 2, "Garcia Maria Sol", ""), ("e", 3, "Bo New", "X@y.org"), ("f", 1, "Ana Old", "")], "entity string, rank int, name string, email string")
    filed = spark.createDataFrame([("e", "Maria Garcia Ruiz", "x@y.org"), ("f", "Other Name", None)], "entity string, name string, email string")
    got = {(r["entity"], r["rank"]): (r["known"], r["place"]) for r in resolve.on_file(people, filed, "entity", "rank").collect()}
    assert got == {("e", 1): (False, 1), ("e", 2): (True, 2), ("e", 3): (True, 3), ("f", 1): (False, 1)}
    words = lambda t: t.lower().split()
    names = spark.createDataFrame([(1, "IT", words("Liceo Rossi San Marco")), (2, "IT", words("Liceo Rossi Pisa")), (3, "ES", words("Liceo Rossi Pisa")), (4, "IT", words("Liceo Bianchi Rossi Pisa")), (5, "IT", words("Pisa"))], "name_id int, country string, words array<string>")
    reg = spark.createDataFrame([(1, "g1", "IT", words("San Marco"), words("Rossi Liceo")), (2, "g2", "IT", words("Pisa"), words("Rossi Liceo Pisa")), (3, "g3", "IT", words("Pisa"), words("Rossi Bianchi")), (4, "g4", "IT", words("Pisa"), words("Bianchi Rossi"))], "entry_id int, grp string, country string, town array<string>, words array<string>")
    assert sorted(tuple(r) for r in resolve.town_match(names, reg, ("liceo",)).collect()) == [(1, "g1"), (2, "g2")]
    assert [tuple(r) for r in resolve.town_match(names, reg.filter("entry_id < 4"), ("liceo",)).filter("name_id = 4").collect()] == [(4, "g3")]


# ---- rules extraction


def slow_extract(lines, own):
    roles, stems = [(k, [re.compile(p) for p in ps]) for k, ps in ct.ROLE_CLASSES], None
    role = lambda t: next((k for k, ps in roles if any(p.search(norm(t)) for p in ps)), None)
    name_re = re.compile(extraction.NAME.replace(r"\p{L}", r"[^\W\d_]"))
    person = lambda t: next((m.group(1) for m in name_re.finditer(t) if not any(norm(w).strip(".") in extraction.NO_NAMES for w in m.group(1).split())), None)
    mail, used, out = re.compile(ct.EMAIL), set(), []
    for i, (page, n, t) in enumerate(lines):
        near = lambda k, i=i, page=page: [x for x in lines[max(0, i - k) : i + k + 1] if x[0] == page]
        k = role(t)
        who = next(((x[1], person(x[2])) for x in near(2) if person(x[2])), None)
        if not k or not who:
            continue
        toks = set(re.findall("[a-z]{4,}", norm(who[1])))
        if who[1] in used or (own and toks and 2 * len(toks & own) >= len(toks)):
            continue
        used.add(who[1])
        at = next((x[1] for x in near(2) + near(5) if mail.search(x[2])), 0)
        out.append((who[1], k, n, who[0], at))
    del stems
    order = list(resolve.ROLE_CONFIDENCE)
    out.sort(key=lambda c: (order.index(c[1]), c[4] == 0))
    partners, seen = [], set()
    for i, (page, _, t) in enumerate(lines):
        if not re.search(extraction.PARTNER_HEADING, t) or len(t) >= 90:
            continue
        found, gap = [], 0
        for p2, n2, t2 in lines[i + 1 : i + 200]:
            if p2 != page:
                break
            toks = {w for w in re.findall("[a-z0-9]{4,}", norm(t2)) if w not in extraction.STOP}
            if re.search(extraction.INSTITUTION, t2) and len(t2) < 120 and not (own and toks and toks <= own):
                found.append((n2, t2))
                gap = 0
            else:
                gap += 1
                if gap > 6:
                    break
        if len(found) >= 3:
            partners += [f for f in found[:80] if f[0] not in seen and not seen.add(f[0])]
    head = " ".join(t for _, n, t in lines if n <= 120).lower()
    return out[:3], partners[:300], next((k for k, p in extraction.KINDS if re.search(p, head)), "unknown")


def test_rules_extraction_equals_slow_version(spark):
    rnd = random.Random(5)
    pool = ["Anna Berger", "Dr. Carl Meier, Erasmus coordinator", "Secretariat", "Head of International Relations", "Partner universities", "University of Graz", "Lycée Jean Moulin", "info@x.org", "some words here", "Director", "José Núñez Pérez", "Our Team", "Graz School", "x", "mobility officer Eva Lang", "Bo Ek eva@y.org", "Research Institute"]
    rows, want = [], {}
    for e in range(25):
        lines, n = [], 0
        for page in range(rnd.randrange(1, 4)):
            for _ in range(rnd.randrange(5, 60)):
                n += 1
                lines.append((f"p{page}", n, rnd.choice(pool)))
        own = {"graz", "berger"} if e % 3 == 0 else set()
        want[e] = slow_extract(lines, own)
        rows += [(e, *x) for x in lines]
    df = spark.createDataFrame(rows, "entity int, page string, n int, line string").repartition(4)
    own = spark.createDataFrame([(e, ["graz", "berger"] if e % 3 == 0 else []) for e in range(25)], "entity int, tokens array<string>")
    people = {}
    for r in extraction.rules_contacts(df, own, "entity").orderBy("entity", "place").collect():
        people.setdefault(r["entity"], []).append((r["name"], r["role_class"], r["role_n"], r["name_n"], r["email_n"]))
    partners = {}
    for r in extraction.rules_partners(df, own, "entity").orderBy("n").collect():
        partners.setdefault(r["entity"], []).append((r["n"], r["name"]))
    kinds = {r["entity"]: r["kind"] for r in extraction.institution_kind(df, "entity").collect()}
    for e, (a, b, k) in want.items():
        assert people.get(e, []) == a and partners.get(e, []) == sorted(b) and kinds[e] == k, e
    assert sum(map(len, people.values())) > 25 and sum(map(len, partners.values())) > 50


# ---- one number once


def slow_numbers(rows, people, tried):
    digits = lambda x: re.sub(r"\D", "", str(x or ""))[-8:]
    used, out = set(), []
    for order, institute, numbers in rows:
        skip = {digits(t) for i, t in tried if i == institute}

        def fresh(x, skip=skip):
            d = digits(x)
            if len(d) < 6 or d in used or d in skip:
                return False
            used.add(d)
            return True

        mine = sorted(p for p in people if p[0] == order)
        wanted = [*numbers[:2], *[p[2] for p in mine if p[1] == 0], *numbers[2:]]
        took = 0
        for x in wanted:
            if took < 3 and fresh(x):
                out.append((order, 0, x.strip()))
                took += 1
        out += [(order, p, x.strip()) for _, p, x in mine if p > 0 and fresh(x)]
    return sorted(out)


@pytest.mark.parametrize("seed", range(4))
def test_lead_numbers_equal_the_ordered_fold(spark, seed):
    rnd = random.Random(seed)
    number = lambda: rnd.choice([None, "12", *[f"+49 30 {k:06d}" for k in range(30)], "555 000 11"])
    rows = [(k, f"i{k % 5}", [number() for _ in range(rnd.randrange(2, 7))]) for k in range(40)]
    people = [(k, p, number()) for k in range(40) for p in range(rnd.randrange(4))]
    tried = [(f"i{rnd.randrange(5)}", f"+49 30 {rnd.randrange(30):06d}") for _ in range(10)]
    want = slow_numbers(rows, people, tried)
    from tidewell.functions.keys import phone_hash

    t = spark.createDataFrame(tried, "institute string, phone string").select("institute", phone_hash(F.col("phone")).alias("hash"))
    got = allocation.lead_numbers(spark.createDataFrame(rows, "row int, institute string, numbers array<string>"), spark.createDataFrame(people, "row int, person int, phone string"), t, "row")
    assert sorted((r["row"], r["person"], r["number"]) for r in got.collect()) == want


# ---- register match, site candidates


def slow_register(names, register, areas):
    out = {}
    for i, words, area in names:
        sigs = next((areas[area[:n]] for n in (4, 3, 2) if area[:n] in areas and len(area) >= n), set())
        want, scored = set(words), []
        for code, sig, nm, towns, label, private in register:
            hit = want & (set(nm) | set(towns))
            if sig not in sigs or not hit:
                continue
            both = 0.25 if want & set(towns) and want & set(nm) else 0
            scored.append(((round(len(hit) / len(want) + both, 3), round(len(want & set(label)) / max(1, len(set(label))), 3), not private), code))
        top = max(s for s, _ in scored) if scored else (0,)
        if top[0] >= 0.99:
            codes = sorted(c for s, c in scored if s == top)
            out[i] = (codes[0], len(codes) > 1)
    return out


def test_register_best_equals_all_pairs(spark):
    rnd = random.Random(8)
    word = lambda: rnd.choice("abcdefghij")
    register = [(f"c{k:03d}", rnd.choice(["MI", "RM"]), [word() for _ in range(rnd.randrange(1, 4))], [word() for _ in range(rnd.randrange(0, 3))], [word() for _ in range(rnd.randrange(0, 4))], rnd.random() < 0.5) for k in range(80)]
    areas = {"02": {"MI"}, "0298": {"RM"}, "06": {"RM", "MI"}}
    names = [(k, sorted({word() for _ in range(rnd.randrange(0, 6))}), rnd.choice(["0298 1", "02 33", "06", "0", "", "099"])) for k in range(150)]
    got = similar.register_best(
        spark.createDataFrame(names, "name_id int, words array<string>, area string"),
        spark.createDataFrame(register, "code string, sig string, names array<string>, towns array<string>, label array<string>, private boolean"),
        spark.createDataFrame([(p, s) for p, ss in areas.items() for s in ss], "prefix string, sig string"),
    )
    want = slow_register([n for n in names if n[1]], register, areas)
    assert {r["name_id"]: (r["code"], r["ambiguous"]) for r in got.collect()} == want and len(want) > 40 and any(a for _, a in want.values())


def test_site_candidates(spark):
    names = [(1, "Yaşar Universitesi"), (2, "IES Albaida"), (3, "Müller Schule Köln"), (4, "Nothing Fits"), (5, "Graz Academy")]
    sites = [("yasar.edu.tr", "Yasar"), ("www.ies-albaida.net", "welcome"), ("mueller-schule.de", "Müller Schule in Köln"), ("muller.org", "x"), ("academygraz.org", "graz academy"), ("graz-academy.at", "graz academy")]
    got = similar.site_candidates(spark.createDataFrame(names, "name_id int, name string"), spark.createDataFrame(sites, "host string, text string"), ("universitesi", "schule"))
    found = {(r["name_id"], r["host"]): (r["proof"], r["unique"]) for r in got.collect()}
    assert {k for k in found} == {(1, "yasar.edu.tr"), (2, "www.ies-albaida.net"), (3, "mueller-schule.de"), (3, "muller.org"), (5, "academygraz.org"), (5, "graz-academy.at")}
    assert found[1, "yasar.edu.tr"][1] and found[3, "mueller-schule.de"][1] and not found[3, "muller.org"][1]
    assert not one(spark, similar.listing_fits(A, B), a="gym-tropaion.ark.sch.gr", b="Lyceum Tropaia") and one(spark, similar.listing_fits(A, B), a="lyk-tropaion.ark.sch.gr", b="Lyceum Tropaia")


# ---- reuse, pace, turns


def test_reuse_as_of(spark):
    day = lambda s: dt.date.fromisoformat(s) if s else None
    index = [("n:malta", "first", "r1", "2026-10-01", True), ("n:malta", "third", "r9", "2026-12-01", True), ("w:um.mt", "old", "r2", "2025-01-01", True), ("n:bad", "first", "r3", "2026-10-01", False), ("w:good.org", "first", "r4", "2026-09-01", True), ("w:ageless", "x", "r5", None, True)]
    rows = [
        ("same", ["n:malta"], "second", "2026-10-26", ("first", "r1")), ("before", ["n:malta"], "second", "2026-09-30", None), ("later", ["n:malta"], "second", "2026-12-02", ("third", "r9")),
        ("own", ["n:malta", "w:good.org"], "first", "2026-10-26", None), ("old", ["w:um.mt"], "second", "2026-10-26", None), ("next", ["n:bad", "w:good.org"], "second", "2026-10-26", ("first", "r4")),
        ("order", ["w:good.org", "n:malta"], "second", "2026-10-26", ("first", "r4")), ("none", [], "second", "2026-10-26", None), ("unknown", ["n:else"], "second", "2026-10-26", None), ("ageless", ["w:ageless"], "b", "2026-10-26", ("x", "r5")),
    ]
    got = reuse.reuse_as_of(
        spark.createDataFrame([(i, k, b, day(d)) for i, k, b, d, _ in rows], "row_id string, keys array<string>, batch string, day date"),
        spark.createDataFrame([(k, b, r, day(d), g) for k, b, r, d, g in index], "key string, batch string, result string, at date, good boolean"),
    )
    assert {r["row_id"]: (r["batch"], r["result"]) for r in got.collect()} == {i: w for i, *_, w in rows if w}


def test_paces_equal_the_loop(spark):
    rnd, rows, want = random.Random(4), [], {}
    for key in range(6):
        run, gap, p = 0, 0.0, [0.02, 0.1, 0.3, 0.0, 0.6, 0.5][key]
        for k in range([350, 350, 7, 350, 350, 0][key]):
            no = rnd.random() < p
            run, gap = pacing.answered(run, gap, no)
            rows.append((key, k, no))
            want[key, k] = gap
    df = spark.createDataFrame(rows, "key int, at int, no boolean").repartition(5)
    got = {(r["key"], r["at"]): r["gap"] for r in pacing.paced(df, "key", "at", "no", 23).collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want) and max(want.values()) == 30.0


def test_summed_stretches(spark):
    rnd = random.Random(5)
    for _ in range(300):
        said = [rnd.random() < rnd.choice([0.05, 0.3]) for _ in range(rnd.randrange(60))]
        whole = pacing.summed(said)
        for run in range(10):
            start = rnd.choice([0.0, 0.3, 0.5, 0.6, 1.4, 2.0, 9.0, 30.0])
            r, g = run, start
            for no in said:
                r, g = pacing.answered(r, g, no)
            assert whole[run][0] == r and abs(pacing.value(whole[run][1], start) - g) < 1e-9


def test_round_robin_of_several_kinds(spark):
    kinds = ["staff", "partners", "erasmus", "campus"]

    def loop(cands, k):
        queues, chosen = {t: [c for c in cands if t in c[2]] for t in kinds}, []
        while len(chosen) < k and any(queues.values()):
            for t in kinds:
                queues[t] = [c for c in queues[t] if c[0] not in chosen]
                if queues[t] and len(chosen) < k:
                    chosen.append(queues[t].pop(0)[0])
        return (chosen + [c[0] for c in cands if c[0] not in chosen])[:k]

    rnd, rows, want = random.Random(6), [], {}
    groups = [[("u1", 20, ["erasmus"]), ("u2", 19, ["erasmus"]), ("u3", 18, ["erasmus"]), ("s1", 8, ["staff"]), ("p1", 6, ["partners"])]]
    groups += [[(f"x{k:02d}", rnd.randrange(5), rnd.sample(kinds, rnd.randrange(4))) for k in range(rnd.randrange(12))] for _ in range(30)]
    for g, cands in enumerate(groups):
        rows += [(g, *c) for c in cands]
        if cands:
            want[g] = loop(sorted(cands, key=lambda c: (-c[1], c[0])), 3)
    got = {}
    for r in rollups.round_robin_kinds(spark.createDataFrame(rows, "g int, id string, score int, kinds array<string>"), "g", "id", "score", "kinds", kinds, 3).orderBy("g", "place").collect():
        got.setdefault(r["g"], []).append(r["id"])
    assert got == want and got[0] == ["s1", "p1", "u1"]
