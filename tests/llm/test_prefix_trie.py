import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from tidewell.llm import prefix_trie as pt
from tidewell.llm.q11_prefix_trie import op11_prefix_trie, rebuilt

SF = "/root/testdata/sf0.001"
NAMES = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def slow(convs):
    """From id and its list of (role, text)."""
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = defaultdict(list)
    for p in members:
        if p:
            children[p[:-1]].append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[x] for x in children[p]) or 1
        saved[p] = sum(saved[x] for x in children[p]) + (len(members[p]) - 1) * (len(p[-1][1]) if p else 0)
    ends = lambda p: hashlib.sha256(",".join(str(c) for c in sorted(members[p]) if len(convs[c]) == len(p)).encode()).hexdigest()
    return sorted(((min(m), len(p), min(members[p[:-1]]) if p else -1, len(m), len(children[p]), leaves[p], saved[p], ends(p)) for p, m in members.items()))


def rebuild(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(x, key=lambda t: t[:2])] for c, x in own.items()}
    h = {c: zlib.crc32(str(c).encode()) % 6 for c in own}
    return {c: own.get(c - c % 100, [])[: h[c]] + x[h[c] :] for c, x in own.items()}


def got(df):
    return sorted((*r[:2], -1 if r[2] is None else r[2], *r[3:]) for r in map(tuple, df.select(NAMES).collect()))


def frame(spark, convs):
    rows = [(c, k, r, t, "clash") for c, turns in convs.items() for k, (r, t) in enumerate(turns)]
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, seq string").repartition(3)


@pytest.mark.parametrize("seed,partitions", [(1, 1), (2, 3), (3, 7), (4, 16)])
def test_random_tries(spark, seed, partitions):
    rnd = random.Random(seed)
    convs = {rnd.randrange(10**6): [(rnd.choice("ua"), rnd.choice(["x", "yy", "zzz"][: 1 + rnd.randrange(3)])) for _ in range(rnd.randrange(1, 7))] for _ in range(120)}
    hot = [("u", "hot"), ("a", "answer")]
    convs |= {10**6 + k: hot for k in range(150)} | {2 * 10**6: [("u", "long")] * 300, 2 * 10**6 + 1: [("u", "long")] * 299}
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        assert got(pt.prefix_trie(pt.conversation_turns(frame(spark, convs)))) == slow(convs)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_pieces_and_batches(spark, monkeypatch):
    run = pt.Run()
    for k in range(5000):
        run.add(k)
    assert len(run.pieces) > 3 and run.digest() == hashlib.sha256(",".join(map(str, range(5000))).encode()).hexdigest()
    convs = {k: [("u", "same")] for k in range(4000)}
    assert got(pt.prefix_trie(pt.conversation_turns(frame(spark, convs)))) == slow(convs)


def test_odd_tables(spark):
    schema = "conv_id long, turn long, role string, text string"
    assert pt.prefix_trie(pt.conversation_turns(spark.createDataFrame([], schema))).collect() == []
    rows = [(1, 0, None, "a"), (1, None, "u", None), (1, 0, None, "a"), (None, 0, "u", "lost"), (2, None, "u", ""), (3, 5, "ua", ""), (4, 5, "u", "a")]
    want = slow({1: [("u", ""), ("", "a"), ("", "a")], 2: [("u", "")], 3: [("ua", "")], 4: [("u", "a")]})
    assert got(pt.prefix_trie(pt.conversation_turns(spark.createDataFrame(rows, schema)))) == want


def test_rebuilt(spark):
    rnd = random.Random(9)
    rows = [(c, k if rnd.random() < 0.9 or k else None, rnd.choice(["u", None]), rnd.choice(["p", "q", None])) for c in [*range(0, 230, 3), 300, 399, 512] for k in range(rnd.randrange(1, 8))]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert got(pt.prefix_trie(rebuilt(pt.conversation_turns(df)))) == slow(rebuild(rows))


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert got(op11_prefix_trie(spark, SF)) == slow(rebuild(rows))
