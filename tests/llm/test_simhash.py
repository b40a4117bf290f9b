import random

import xxhash

from tidewell.llm import simhash


def slow_fingerprint(text):
    import re

    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    grams = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(rows):
    ids = [r[0] for r in rows]
    fps = [slow_fingerprint(r[1]) for r in rows]
    up = list(range(len(rows)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= 2:
                up[top(i)] = top(j)
    least = {}
    for i in range(len(rows)):
        least.setdefault(top(i), []).append(ids[i])
    return sorted((ids[i], fps[i], min(least[top(i)])) for i in range(len(rows)))


def test_matches_brute_force(spark):
    rnd = random.Random(5)
    vocab = [f"w{i}" for i in range(300)] + ["É", "Straße", "ÀB"]
    rows = []
    for i in range(150):
        words = [rnd.choice(vocab) for _ in range(rnd.randrange(0, 120))]
        rows.append((len(rows), " ".join(words)))
        for _ in range(rnd.randrange(3)):
            copy = list(words)
            if copy and rnd.random() < 0.7:
                copy[rnd.randrange(len(copy))] = "changed"
            rows.append((len(rows), "\t".join(copy).upper() if rnd.random() < 0.3 else " ".join(copy)))
    rows += [(len(rows), None), (len(rows) + 1, ""), (len(rows) + 2, " \n\t"), (len(rows) + 3, "one"), (len(rows) + 4, "one two")]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, fp string, k int")
    got = sorted((r["id"], r["fp"] % (1 << 64), r["component"]) for r in simhash.near_duplicates(df).collect())
    assert got == brute(rows)


def test_large_buckets_lose_no_link(spark):
    """A crowd of fingerprints in one bucket: the balls must connect what all pairs would."""
    rnd = random.Random(1)
    base = rnd.getrandbits(64)
    fps = {base ^ sum(1 << b for b in rnd.sample(range(64), rnd.randrange(7))) for _ in range(400)}
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    df = spark.createDataFrame([(signed(x),) for x in fps], "fp long")
    for bucket in (4, 48, 10_000):
        root = {r["node"]: r["root"] for r in simhash.components(simhash.links(df, 2, bucket)).collect()}
        up = {x: x for x in fps}

        def top(x):
            while up[x] != x:
                x = up[x]
            return x

        for a in fps:
            for b in fps:
                if bin(a ^ b).count("1") <= 2:
                    up[top(a)] = top(b)
        for a in fps:
            for b in fps:
                assert (top(a) == top(b)) == (root.get(signed(a), a) == root.get(signed(b), b) or a == b)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(df).collect() == []


def test_long_chain(spark):
    chain = spark.range(200).selectExpr("id AS a", "id + 1 AS b")
    assert simhash.components(chain).select("root").distinct().count() == 1


def test_query(spark, tmp_path):
    from tidewell.llm.q01_simhash import op1_simhash

    rows = [(3, "a b c d"), (2, "A  b C d"), (5, None), (4, "\t"), (9, "quite other words here"), (3, "a b c d")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted((r["doc_id"], int(r["fingerprint"], 16), r["component_id"]) for r in op1_simhash(spark, str(tmp_path)).collect())
    assert got == brute(rows)


def test_hot_fingerprints_are_joined_alike(spark, monkeypatch):
    """Keys and buckets beyond the bound of hot ones take the broadcast and give the same groups."""
    from tidewell.llm import common

    rows = [(k, f"same words in all of them {k % 3}") for k in range(40)] + [(100 + k, f"unlike {k} all others {k * 7}") for k in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute(rows)
    monkeypatch.setattr(simhash, "HOT_BUCKET", 2)
    inner = common.join_unique
    monkeypatch.setattr(simhash, "join_unique", lambda a, b, key: inner(a, b, key, 3))
    got = sorted((r["id"], r["fp"] % (1 << 64), r["component"]) for r in simhash.near_duplicates(df).collect())
    assert got == want
