import random
import re

import pytest

from tidewell.llm.q10_quality_rules import op10_quality_rules
from tidewell.llm.quality_rules import clean_documents, clean_text, measure

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = {}
    for k in range(len(words) - 7):
        windows.setdefault(tuple(words[k : k + 8]), []).append(k)
    inside = {k + j for at in windows.values() if len(at) > 1 for k in at for j in range(8)}
    failed = len(words) < 20 or 100 * len(inside) > 30 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(inside), failed


COLS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def test_base_counts_equal_brute_force(spark):
    rnd = random.Random(3)
    words = ["a", "bb", "é", "#x", "c|d", " ", "😀", "end.", " "]
    docs = [None, "", "\n\n", " \t", "a " * 20, "a b c d e f g h " * 2, "x\n" * 30, "ok then. " * 4000]
    for _ in range(80):
        docs.append("".join(rnd.choice(words) + rnd.choice([" ", " ", " ", "\n", "\t", "\x0b", "  "]) for _ in range(rnd.randrange(90))))
    docs += docs[-3:]
    got = measure(spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")).collect()
    assert len(got) == len(docs)
    for r in got:
        assert tuple(r[c] for c in COLS) == brute(docs[r["doc_id"]]), docs[r["doc_id"]]
        assert not (r["kept"] and r["base_failed"])


class Sentence:  # no eight words of it recur in another one
    @staticmethod
    def format(k):
        return " ".join(f"{w}{k}" for w in "this is a plain sentence that says something of its own".split()) + "."


SENTENCE = Sentence


@pytest.mark.parametrize(
    "bad",
    ["Home | About | Contact | Help", "Click here to read our newsletter", "All rights reserved by the owner.", "buy!! now!! cheap!! today!!", "### *** $$$ %%% word", "a line of words without any end"],
)
def test_failing_lines_go_and_others_stay(spark, bad):
    good = [SENTENCE.format(k) for k in range(6)]
    docs = spark.createDataFrame([(1, "\n".join([good[0], bad, "", *good[1:]])), (2, "\n".join(good))], "doc_id long, text string")
    texts = {r["doc_id"]: r["text"] for r in clean_documents(docs).collect()}
    assert texts == {1: "\n".join([good[0], "", *good[1:]]), 2: "\n".join(good)}


def test_a_document_that_loses_too_much_goes(spark):
    menu = "\n".join(f"menu {k} | item {k} | other {k} | last {k}" for k in range(40))
    docs = spark.createDataFrame([(1, SENTENCE.format(1) + "\n" + menu), (2, None)], "doc_id long, text string")
    assert clean_documents(docs).count() == 0
    assert not measure(docs).filter("doc_id = 1").first()["base_failed"]


def test_odd_tables(spark):
    docs = spark.createDataFrame([(None, SENTENCE.format(1) + "\n" + SENTENCE.format(2), "n", 1, "r")] * 2, "doc_id long, text string, kept string, n_words int, line string")
    got = clean_documents(docs).collect()
    assert len(got) == 2 and got[0].asDict() == docs.first().asDict()
    empty = docs.limit(0)
    assert measure(empty).count() == 0 and clean_documents(empty).columns == docs.columns
    assert spark.createDataFrame([(None,)], "t string").select(clean_text("t").alias("x")).first()["x"] is None


def test_query_covers_the_table(spark):
    sf = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = op10_quality_rules(spark, sf).collect()
    assert len(got) == len(texts)
    assert all(tuple(r[c] for c in COLS) == brute(texts[r["doc_id"]]) for r in got)
