import random
import re

import pytest

from tidewell.llm import decontamination as dc


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items):
    out = []
    for i, t in docs:
        w, hit, ids = words(t), set(), set()
        for k, x in items:
            v = words(x)
            n = min(10, len(v))
            if not n:
                continue
            wins = {tuple(v[s : s + n]) for s in range(len(v) - n + 1)}
            for p in range(len(w) - n + 1):
                if tuple(w[p : p + n]) in wins:
                    hit |= set(range(p, p + n))
                    ids.add(str(k))
        out.append((i, len(w), len(hit), sorted(ids)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("broadcast", [True, False])
def test_matches_brute_force(spark, monkeypatch, broadcast):
    if not broadcast:
        monkeypatch.setattr(dc, "BROADCAST_ROWS", -1)
    rnd = random.Random(2)
    vocab = ["the", "of", "Élan", "a1", "x", "yy", "zz", "Q", "w9"]
    say = lambda n: " ".join(rnd.choice(vocab) for _ in range(n))
    items = [(k, say(rnd.choice([0, 1, 3, 9, 10, 11, 30]))) for k in range(25)] + [(99, None), (98, "..."), (5, say(12))]
    docs = []
    for k in range(80):
        t = say(rnd.randrange(60))
        for _ in range(rnd.randrange(3)):
            v = words(rnd.choice(items)[1])
            a = rnd.randrange(len(v) + 1)
            t += " " + ", ".join(v[a : a + rnd.randrange(25)]).upper() + "." + say(rnd.randrange(9))
        docs.append((k, t))
    docs += [(200, None), (201, ""), (202, "--"), (7, "x yy zz"), (None, items[3][1]), docs[4]]
    df = spark.createDataFrame([(*d, 1, "t") for d in docs], "doc_id long, text string, h int, found string")
    bench = spark.createDataFrame([(*i, 2) for i in items], "item_id long, text string, n int")
    got = [(r["id"], r["n_words"], r["n_hit"], r["item_ids"]) for r in dc.contamination(df, bench).collect()]
    assert sorted(got, key=repr) == brute(docs, items)
    left = dc.drop_contaminated(df, bench).collect()
    clean = [x for x in brute(docs, items) if not x[2]]
    assert sorted((repr(r["doc_id"]) for r in left)) == sorted(repr(x[0]) for x in clean) and set(left[0].asDict()) == set(df.columns) if left else not clean


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    assert dc.contamination(none, bench).collect() == []
    one = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    assert [tuple(r)[2:] for r in dc.contamination(one, bench.limit(0)).collect()] == [(3, 0, [], 0)]


def brute_near(docs, items, terms=3, span=20):
    """Distinct items per row a stretch of which holds the rarest terms of the item."""
    texts = [words(t) for _, t in docs]
    df = {}
    for w in texts:
        for x in w:
            df[x] = df.get(x, 0) + 1
    out = []
    for w in texts:
        near = set()
        for k, t in items:
            rare = sorted({(df.get(x, 0), x) for x in words(t)})[:terms]
            if rare and rare[0][0] and k is not None:
                want = {x for _, x in rare}
                if any(want <= set(w[p : p + span]) for p in range(len(w))):
                    near.add(k)
        out.append(len(near))
    return out


def test_proximity_of_the_query(spark):
    rnd = random.Random(6)
    vocab = [f"v{k}" for k in range(60)] + ["the", "of"]
    say = lambda n: " ".join(rnd.choice(vocab) for _ in range(n))
    items = [(k, say(rnd.choice([0, 1, 2, 5, 12]))) for k in range(20)] + [(50, "v1 nowhere"), (51, "v1 v2")]
    docs = [(k, say(rnd.randrange(90))) for k in range(60)] + [(90, None), (91, "v1 v2"), (91, "v2 " + "x " * 18 + "v1"), (92, "v2 " + "x " * 19 + "v1")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = dc.contamination(df, spark.createDataFrame(items, "item_id long, text string")).collect()
    want = sorted(zip([d[0] for d in docs], brute_near(docs, items), strict=True))
    assert sorted((r["id"], r["n_near"]) for r in got) == want and any(n for _, n in want)


def test_terms_beyond_the_broadcast(spark, monkeypatch):
    """Shuffled terms, dealt in parts, give the same postings."""
    df = spark.createDataFrame([(k, "a b the the " * 3) for k in range(9)], "doc_id long, text string")
    terms = spark.createDataFrame([("the",), ("b",)], "term string")
    rows = lambda: sorted(map(tuple, dc.build_index(df, terms).collect()))
    counts = lambda: sorted(map(tuple, dc.count_terms(df, terms).collect()))
    one, n = rows(), counts()
    monkeypatch.setattr(dc, "BROADCAST_TERMS", -1)
    assert rows() == one and counts() == n == [("b", 27), ("the", 54)]


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "alpha x x beta y gamma"), (2, "alpha " + "x " * 40 + "beta gamma"), (3, "gamma beta alpha")], "doc_id long, text string")
    tokens = dc.item_tokens(spark.createDataFrame([(7, "alpha beta gamma")], "item_id long, text string"), "item_id", "text")
    rare = dc.rare_of_items(tokens, dc.count_terms(docs, tokens), 3)
    got = dc.proximity_matches(dc.build_index(docs), rare, span=6).collect()
    assert sorted((r["id"], r["first"], r["last"]) for r in got) == [(1, 0, 5), (3, 0, 2)]


def test_query_equals_its_sql(spark):
    import duckdb

    from tidewell.llm.q04_decontamination import SQL, op4_decontamination

    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    df = op4_decontamination(spark, sf)
    cols = sorted(df.columns)
    assert sorted(map(tuple, df.select(cols).collect())) == sorted(con.sql(f"SELECT {', '.join(cols)} FROM ({SQL})").fetchall())
