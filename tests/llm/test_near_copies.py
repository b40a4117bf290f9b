import random

import corpus_pipeline as cp
from tidewell.llm import near_copies
from tidewell.llm.common import read_table

SF = "/root/testdata/sf0.01"


def grams(text):
    w = (text or "").lower().split()
    return {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))}


def brute(rows):
    up = list(range(len(rows)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    sets = [grams(t) for _, t in rows]
    for i in range(len(rows)):
        for j in range(i):
            if len(sets[i] & sets[j]) / len(sets[i] | sets[j]) >= 0.8:
                up[top(i)] = top(j)
    least = {}
    for i, (k, _) in enumerate(rows):
        least[top(i)] = min(least.get(top(i), k), k)
    return sorted(least.values())


def edited(rnd, words, k):
    out = list(words)
    for i in rnd.sample(range(len(out)), k):
        out[i] = f"new{rnd.random()}"
    return out


def test_stage_drops_near_copies(spark):
    """Copies with a few words changed, far beyond two bits; one word in ten changed is no near copy."""
    rnd = random.Random(3)
    rows = []
    for g in range(40):
        words = [f"w{rnd.randrange(500)}" for _ in range(150)]
        rows += [(100 * g + j, " ".join(edited(rnd, words, c))) for j, c in enumerate([0, 1, 2, 3, 15])]
    stage = cp.STAGES[1][1]
    df = spark.createDataFrame([(k, t, "x") for k, t in rows], "doc_id long, text string, source string")
    got = sorted(r["doc_id"] for r in stage(spark, df, SF).collect())
    assert got == brute(rows) and len(got) < 100


def test_large_buckets_lose_no_link(spark):
    """A chain of copies, each unlike its end: the least node alone links only some."""
    rnd = random.Random(4)
    words = [f"w{k}" for k in range(120)]
    rows = []
    for k in range(60):
        rows.append((k, " ".join(words)))
        words = edited(rnd, words, 1)
    rows += [(100 + k, " ".join(edited(rnd, [f"w{j}" for j in range(120)], rnd.randrange(1, 6)))) for k in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for bucket in (2, 48, 10_000):
        assert sorted(r["id"] for r in near_copies.representatives(df, bucket=bucket).collect()) == brute(rows)


def test_tables_against_brute_force(spark):
    docs = read_table(spark, SF, "documents").filter("text IS NOT NULL AND doc_id IS NOT NULL").limit(1000)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = sorted(r["id"] for r in near_copies.representatives(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == brute(rows)


def test_many_pairs_just_below_the_threshold(spark):
    """Copies of one text whose edits leave them near 0.8 of it and of one another, beside a few that are copies of copies."""
    rnd = random.Random(6)
    base = [f"w{k}" for k in range(140)]
    made = [edited(rnd, base, rnd.randrange(2, 8)) for _ in range(120)]
    made += [edited(rnd, made[k], 1) for k in range(0, 60, 3)]
    made += [base[:70] + [f"own{k}-{j}" for j in range(rnd.randrange(10, 40))] + base[70:] for k in range(40)]
    rows = [(k, " ".join(w)) for k, w in enumerate(made)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    for bucket in (3, 12, 48):
        assert sorted(r["id"] for r in near_copies.representatives(df, bucket=bucket).collect()) == brute(rows)


def test_bounds_lose_no_similar_pair(spark):
    import numpy as np
    from pyspark.sql import functions as F

    rnd = random.Random(7)
    rows = []
    for k in range(400):
        n = rnd.choice([1, 3, 40, 200, 3000])
        x = {rnd.getrandbits(64) for _ in range(n)}
        y = {h if rnd.random() > 0.15 else rnd.getrandbits(64) for h in x} | {rnd.getrandbits(64) for _ in range(rnd.randrange(1 + n // 8))}
        sets = [np.array(sorted(s), np.uint64) for s in (x, y)]
        rows.append((len(x & y) / len(x | y), *[v for s in sets for v in (len(s), near_copies.bitmap(s))]))
    df = spark.createDataFrame(rows, "j double, a_n long, a_bits array<long>, b_n long, b_bits array<long>")
    got = df.select("j", near_copies.possible("a_", "b_", 0.8).alias("p")).collect()
    assert all(r["p"] for r in got if r["j"] >= 0.8) and sum(not r["p"] for r in got) > 50 and sum(r["j"] >= 0.8 for r in got) > 50
    assert df.limit(0).filter(F.lit(True)).collect() == []
