import re

import numpy as np
import xxhash

import corpus_pipeline as cp
from tidewell.llm.common import read_table
from tidewell.llm.q06_bpe import vocabulary
from tidewell.llm.q10_quality_rules import SQL as RULES_SQL

from .test_decontamination import words as bench_words
from .test_pii import base
from .test_near_copies import brute

SF = "/root/testdata/sf0.001"


def test_stages_against_brute_force(spark):
    import duckdb

    docs = read_table(spark, SF, "documents")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    want = {r[0] for r in con.sql(f"SELECT doc_id FROM ({RULES_SQL}) WHERE kept").fetchall()}
    one = cp.quality_rules(spark, docs, SF).cache()
    assert {r["doc_id"] for r in one.collect()} == want and one.columns == docs.columns

    two = cp.simhash_dedup(spark, one, SF).cache()
    assert sorted(r["doc_id"] for r in two.collect()) == brute([(r["doc_id"], r["text"]) for r in one.collect()]) and two.columns == docs.columns

    three = cp.benchmark_decontamination(spark, two, SF).cache()
    windows = set()
    for r in read_table(spark, SF, "benchmark").collect():
        w = bench_words(r["text"])
        windows |= {tuple(w[k : k + min(10, len(w))]) for k in range(len(w) - min(10, len(w)) + 1)} if w else set()
    sizes = {len(w) for w in windows}
    dirty = lambda t: any(tuple(w[k : k + n]) in windows for w in [bench_words(t)] for n in sizes for k in range(len(w) - n + 1))
    assert {r["doc_id"] for r in three.collect()} == {r["doc_id"] for r in two.collect() if not dirty(r["text"])} and three.columns == docs.columns

    four = cp.personal_data(spark, three, SF).cache()
    before = {r["doc_id"]: r["text"] for r in three.collect()}
    for r in four.collect():
        assert not base(r["text"]) and (base(before[r["doc_id"]]) == [] or r["text"] != before[r["doc_id"]])
        plain = re.sub(r"\[(EMAIL|IP|CARD|PHONE|SECRET|ACCOUNT)\]", "\0", r["text"]).split("\0")
        assert all(p in before[r["doc_id"]] for p in plain)
    assert four.columns == docs.columns and four.count() == three.count()

    from tokenizers import Tokenizer

    t = Tokenizer.from_file(vocabulary()[0])
    for r in cp.bpe_coding(spark, four, SF).collect():
        ids = t.encode(r["text"], add_special_tokens=False).ids
        assert np.frombuffer(r["ids"], "<u4").tolist() == ids and r["n_tokens"] == len(ids) and r["decoded"] == r["text"]
    assert xxhash.xxh64_intdigest(b"") is not None


def test_odd_tables(spark):
    rows = [(1, None, "x"), (None, "alone " * 3, "y"), (2, "", None)]
    good = "This is a sentence of several plain words that says little, but it ends well and stays whole, as it should do here."
    rows += [(3, good, "z"), (3, good, "z"), (4, good, "z"), (None, good + " Otherwise it differs in many words at its very end.", "q")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    for name, stage in cp.STAGES:
        more = ["ids", "decoded"] if stage is cp.bpe_coding else []
        assert stage(spark, docs.limit(0), SF).collect() == [], name
        got = stage(spark, docs, SF)
        assert sorted(got.columns) == sorted([*docs.columns, *more]) and len(got.collect()) <= docs.count(), name
    left = cp.simhash_dedup(spark, cp.quality_rules(spark, docs, SF), SF).collect()
    assert sorted((str(r["doc_id"]), r["n_tokens"]) for r in left) == [("3", "z"), ("None", "q")]


def test_rows_of_one_id_in_every_order(spark):
    """A row stays if its id and text are its group's representative's, whatever the order of the rows."""
    import itertools

    a, b = ("The first text has quite other words. " * 4, "Here is another story that shares nothing with it at all. " * 4)
    for rows in itertools.permutations([(1, b), (1, a), (0, b), (1, a)]):
        df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, __node string")
        got = cp.simhash_dedup(spark, df.coalesce(1), SF).collect()
        assert sorted((r["doc_id"], r["text"]) for r in got) == [(0, b), (1, a)]


def test_coding_replaces_clashing_columns(spark):
    df = spark.createDataFrame([(1, "a b", "old", 7), (2, None, "old", 8)], "doc_id long, text string, decoded string, k int")
    got = {r["doc_id"]: r for r in cp.bpe_coding(spark, df, SF).collect()}
    assert got[1]["decoded"] == "a b" and got[2]["decoded"] == "" and got[2]["n_tokens"] == 0 and got[1]["k"] == 7
