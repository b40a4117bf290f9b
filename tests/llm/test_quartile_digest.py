import hashlib
import math
import random
from collections import Counter

import numpy as np
import pytest

from tidewell.llm import quartile_digest as qd
from tidewell.llm.q12_digest import op12_digest

SF = "/root/testdata/sf0.001"


def slow_codes(text):
    raw, counts, mask = text.encode(), Counter(), 0xFFFFFFFF
    for offsets, factors in zip(qd.SPACINGS, qd.FACTORS.tolist(), strict=True):
        for k in range(len(raw) - offsets[-1]):
            h = (sum(raw[k + o] * f for o, f in zip(offsets, factors, strict=False)) + factors[3]) & mask
            h = (h ^ (h >> 15)) * 0x2C1B3C6D & mask
            counts[h >> 24] += 1
    by_size = sorted(counts[b] for b in range(qd.BUCKETS))
    cuts = [by_size[qd.BUCKETS * k // 4 - 1] for k in (1, 2, 3)]
    return [math.floor(math.log(1 + len(raw)) / math.log(1.25) + 1e-12), *[sum(counts[b] > q for q in cuts) for b in range(qd.BUCKETS)]]


def slow_likeness(a, b):
    score = min(64, 8 * abs(a[0] - b[0])) + sum({0: 0, 1: 1, 2: 2, 3: 6}[abs(x - y)] for x, y in zip(a[1:], b[1:], strict=True))
    return 1 - min(512, score) / 512


def slow_digest(c):
    bits = "".join(f"{x:02b}" for x in c[1:])
    return f"{c[0]:02x}" + "".join(f"{int(bits[k : k + 4], 2):x}" for k in range(0, len(bits), 4))


def slow(texts):
    rows, n = [], len(texts)
    texts = [t or "" for t in texts]
    found = [slow_codes(t) for t in texts]
    for k, t in enumerate(texts):
        after = texts[(k + 1) % n]
        made = t[: len(t) - len(t) // 2] + after[: len(t) // 2]
        c = slow_codes(made)
        rows.append((len(t), hashlib.sha256(made.encode()).hexdigest(), slow_digest(found[k]), slow_digest(c), slow_likeness(found[k], c), slow_likeness(found[k], found[(k + 1) % n])))
    return rows


NAMES = ["n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


def table(df):
    return {r["id"]: tuple(r[n] for n in NAMES) for r in df.collect()}


@pytest.mark.parametrize("n", [1, 2, 3, 60])
def test_against_slow_version(spark, n):
    rnd = random.Random(n)
    texts = ["".join(rnd.choice(["ab", "é", "漢", " ", "the", "🙂", "\n"]) for _ in range(rnd.choice([0, 1, 5, 20, 300]))) for _ in range(n)]
    texts[0] = None
    ids = rnd.sample(range(1000), n)
    rows = [(i, t, "clash") for i, t in zip(sorted(ids), texts, strict=True)]
    df = spark.createDataFrame(rnd.sample(rows, n), "doc_id long, text string, pid string").repartition(3)
    got = table(qd.with_neighbours(df))
    assert got == {r[0]: w for r, w in zip(rows, slow(texts), strict=True)}


def test_odd_tables(spark):
    df = spark.createDataFrame([(None, "later"), (2, "x" * 100000), (2, "x" * 100000), (2, "x" * 100000), (1, "")], "doc_id long, text string")
    assert qd.with_neighbours(df.limit(0)).collect() == []
    got = qd.with_neighbours(df).collect()
    assert len(got) == 5 and sum(r["near_next"] == 1 for r in got) == 2
    assert [r["n_chars"] for r in got if r["id"] is None] == [5] and [r["near_edited"] for r in got if r["id"] == 1] == [1]


def test_digests_read_back_and_equal_texts_agree(spark):
    texts = ["", "abc", "a longer text with several words in it, and more", "a longer text with several words in it, and more"]
    found = qd.codes(texts)
    assert all((qd.read(x) == c).all() for x, c in zip(qd.written(found), found, strict=True))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    by = {r["id"]: r["fingerprint"] for r in qd.fingerprints(df).collect()}
    assert by[2] == by[3] and len({by[0], by[1], by[2]}) == 3
    assert qd.likeness(found[2:3], found[3:4])[0] == 1


def test_query_and_separation(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()
    got = table(op12_digest(spark, SF).withColumnRenamed("doc_id", "id"))
    for k in [*range(0, len(docs) - 1, 9), len(docs) - 1]:
        after = docs[(k + 1) % len(docs)]["text"]
        assert got[docs[k]["doc_id"]] == slow([docs[k]["text"], after])[0]
    assert len(got) == len(docs)
    a, b = (np.array([v[k] for v in got.values()]) for k in (4, 5))
    assert (a > b).mean() > 0.95 and a.mean() - b.mean() > 0.15
