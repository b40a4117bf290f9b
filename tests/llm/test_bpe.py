import hashlib
import random

import numpy as np
import pytest

from tidewell.llm.bpe import coder, decode_documents, encode_documents
from tidewell.llm.q06_bpe import vocabulary
from tidewell.llm.token_counts import length_table, quantiles, truncated_total


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(vocabulary()[0])
    t.no_truncation()
    t.no_padding()
    return t


def texts():
    rnd = random.Random(3)
    pool = ["a", "B", " ", "  ", "\n", "\t", "é", "ß", "漢字", "🙂", "'s", "'LL", "12", "½", " ", " ", "\x85", "\x1c", "​", "<|endoftext|>", "...", "the", "aaaa", "́", "\x00", "ﷺ", "३", "᠎"]
    made = ["".join(rnd.choice(pool) for _ in range(rnd.randrange(40))) for _ in range(400)]
    return [*made, "", "x" * 5000, "ab" * 3000, " " * 1000, "Hello world's end, I'll <|endoftext|><|endoftext|> go"]


def test_equals_the_library(library):
    c = coder(*vocabulary())
    xs = texts()
    for x, ids in zip(xs, c.encode(xs), strict=True):
        want = library.encode(x, add_special_tokens=False).ids
        assert ids.tolist() == want, repr(x)
        assert c.decode(ids.astype(np.int64)).decode("utf-8", "replace") == library.decode(want, skip_special_tokens=False)


def test_tables(spark, library):
    xs = [*texts()[:50], None]
    df = spark.createDataFrame([(k, x, "clash") for k, x in enumerate(xs)], "doc_id long, text string, ids string")
    coded = encode_documents(df, *vocabulary(), decode=True)
    back = {r["id"]: r["text"] for r in decode_documents(coded, *vocabulary()).collect()}
    for r in coded.collect():
        want = library.encode(xs[r["id"]] or "", add_special_tokens=False).ids
        assert np.frombuffer(r["ids"], "<u4").tolist() == want and r["n_tokens"] == len(want)
        assert r["decoded"] == (xs[r["id"]] or "") == back[r["id"]]
    assert encode_documents(df.limit(0), *vocabulary()).collect() == []
    assert hashlib.sha256(b"").hexdigest()


def test_length_table(spark):
    rnd = random.Random(4)
    xs = [rnd.choice([0, 1, 5, 900, 1023, 1024, 1025, 5000]) for _ in range(300)]
    table = length_table(spark.createDataFrame([(x,) for x in xs], "n_tokens long"))
    for r in table.collect():
        n = r["n_tokens"]
        assert r["n_docs"] == xs.count(n) and r["docs_longer"] == sum(x > n for x in xs)
        assert r["total_up_to"] == sum(x for x in xs if x <= n) and r["truncated_total"] == sum(min(x, n) for x in xs)
        assert r["total_tokens"] == sum(xs) and r["total_docs"] == len(xs)
    for r in truncated_total(table, [0, 3, 1024, 4000, 9999]).collect():
        assert r["kept_tokens"] == sum(min(x, r["limit"]) for x in xs) and r["cut_docs"] == sum(x > r["limit"] for x in xs)
    for r in quantiles(table, [0.1, 0.5, 1.0]).collect():
        assert r["n_tokens"] == sorted(xs)[int(np.ceil(r["share"] * len(xs))) - 1]
    assert length_table(spark.createDataFrame([], "n_tokens long")).collect() == []


def test_queries(spark, library, tmp_path):
    from tidewell.llm.q06_bpe import op6_bpe, op7_token_counts

    xs = [*texts()[:40], None, "", "same", "same"]
    spark.createDataFrame([(k, x) for k, x in enumerate(xs)], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    want = [library.encode(x or "", add_special_tokens=False).ids for x in xs]
    sha = lambda b: hashlib.sha256(b).hexdigest()
    for r in op6_bpe(spark, str(tmp_path)).collect():
        ids = want[r["doc_id"]]
        assert r["n_tokens"] == len(ids) and r["ids_sha256"] == sha(np.array(ids, "<u4").tobytes())
        assert r["decoded_sha256"] == sha(library.decode(ids, skip_special_tokens=False).encode())
    table = {r["n_tokens"]: r for r in op7_token_counts(spark, str(tmp_path)).collect()}
    sizes = [len(x) for x in want]
    assert set(table) == set(sizes)
    for n, r in table.items():
        assert r["n_docs"] == sizes.count(n) and r["truncated_total"] == sum(min(n, x) for x in sizes) and r["total_tokens"] == sum(sizes)


def test_forgetting_words_changes_nothing(library, monkeypatch):
    from tidewell.llm import bpe

    monkeypatch.setattr(bpe, "KEPT_WORDS", 20)
    c = bpe.BytePairCoder(*vocabulary())
    for k in range(0, 400, 10):
        for x, ids in zip(texts()[k : k + 10], c.encode(texts()[k : k + 10]), strict=True):
            assert ids.tolist() == library.encode(x, add_special_tokens=False).ids
