import random

import numpy as np
import pytest

from tidewell.llm import quality_classifier as qc
from tidewell.llm import toxicity as tx
from tidewell.llm.common import read_table
from tidewell.llm.q03_toxicity import op3_toxicity
from tidewell.llm.q05_quality import op5_quality

SF = "/root/testdata/sf0.1"


def held_out_f1(spark, query, label):
    got = {r["doc_id"]: r for r in query(spark, SF).collect()}
    truth = [(got[r["doc_id"]], r[label]) for r in read_table(spark, SF, "labels").collect() if r["doc_id"] in got]
    assert all(0 <= g["score"] <= 1 and g["predicted"] == int(g["score"] >= 0.7) for g, _ in truth)
    held = [(g["predicted"], y) for g, y in truth if g["held_out"]]
    tp = sum(p and y for p, y in held)
    return 2 * tp / (sum(p for p, _ in held) + sum(y for _, y in held))


def test_quality_on_held_out_rows(spark):
    assert held_out_f1(spark, op5_quality, "quality") > 0.97


def test_toxicity_on_held_out_rows(spark):
    assert held_out_f1(spark, op3_toxicity, "toxic") > 0.85


def test_flat_trees_equal_node_by_node_walk():
    rnd = np.random.default_rng(0)
    x = rnd.normal(size=(500, 4))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.3)).astype(float)
    trees = qc.grow(x, y, rounds=20)

    def walk(row):
        total = trees.base
        for root in trees.roots:
            k = root
            while trees.left[k] != k:
                k = trees.left[k] + (row[trees.feature[k]] > trees.threshold[k])
            total += trees.value[k]
        return total

    assert np.allclose(trees.odds(x), [walk(r) for r in x])
    assert ((trees.odds(x) > 0) == (y > 0)).mean() > 0.95


@pytest.mark.parametrize("labels", [[], [1, 1, 1], [0, 1, 0, 1]])
def test_odd_tables(spark, labels):
    rows = [(k, t, "z") for k, t in enumerate([None, "", " \n", "word", "x " * 3000])]
    df = spark.createDataFrame(rows, "doc_id long, text string, score string")
    sample = spark.createDataFrame([(k, y, "some text here for you %d" % k) for k, y in enumerate(labels)], "id long, label int, text string")
    got = tx.score_documents(df, tx.fit(sample)).collect()
    assert len(got) == 5 and all(0 <= r["score"] <= 1 for r in got)
    trees = qc.fit(np.array([qc.statistics("a b")] * len(labels)).reshape(-1, len(qc.FEATURES)), np.array(labels, float))
    got = qc.score_documents(df, trees).collect()
    assert len(got) == 5 and all(0 <= r["score"] <= 1 for r in got)
    assert tx.score_documents(df.limit(0), tx.fit(sample)).collect() == []


def test_toxic_words_are_found(spark):
    rnd = random.Random(1)
    say = lambda n: " ".join("".join(rnd.choice(["ba", "do", "ki", "re", "tu", "mo"]) for _ in range(rnd.randrange(1, 5))) for _ in range(n))
    rows = []
    for k in range(600):
        y = int(k % 6 == 0)
        rows.append((k, y, say(40) + (f" {rnd.choice(['zlorp', 'grunk'])}{rnd.choice(['', 's', 'ig'])} " if y else " ") + say(40)))
    model = tx.fit(spark.createDataFrame(rows, "id long, label int, text string"))
    test = spark.createDataFrame([(1, "do you grunkel " + say(60)), (2, say(60))], "doc_id long, text string")
    got = {r["id"]: r["score"] for r in tx.score_documents(test, model).collect()}
    assert got[1] >= 0.7 > got[2]
