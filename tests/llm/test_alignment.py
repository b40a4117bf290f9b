import hashlib
import random
from collections import Counter

import pytest

from tidewell.llm import alignment as al
from tidewell.llm.q13_alignment import op13_alignment, vocabularies

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def libraries():
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(vocabularies()[0])
    a.no_truncation()
    a.no_padding()
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=vocabularies()[1])


def slow(texts, libraries):
    """From whole texts and byte offsets, all pairs of overlapping ranges."""
    from tidewell.llm.bpe import byte_letters

    a, b = libraries
    back = {c: n for n, c in byte_letters().items()}
    rows = []
    for t in texts:
        want = f" {t}".encode() if t else b""
        x, y = (a.encode(f" {t}", add_special_tokens=False).ids, b.encode(t)) if t else ([], [])
        said_x = [bytes(back[c] for c in a.id_to_token(k)) for k in x]
        said_y = [bytes([int(b.id_to_piece(k)[3:5], 16)]) if b.is_byte(k) else b.id_to_piece(k).replace("▁", " ").encode() for k in y]
        if not t or b"".join(said_x) != want or b"".join(said_y) != want:
            rows.append(([], [], [], []))
            continue
        spans = []
        for said in (said_x, said_y):
            at, out = 0, []
            for s in said:
                out.append((at, at + len(s)))
                at += len(s)
            spans.append(out)
        both = sorted({e for _, e in spans[0]} & {e for _, e in spans[1]})
        links = [(i, j) for k, (s, e) in enumerate(spans[0]) for m, (u, v) in enumerate(spans[1]) if s < v and u < e for i, j in [(x[k], y[m])]]
        groups, last = [], 0
        for e in both:
            groups.append("|".join(",".join(str(k) for k, (u, v) in zip(ids, sp, strict=True) if last <= u and v <= e) for ids, sp in ((x, spans[0]), (y, spans[1]))))
            last = e
        rows.append((x, y, links, groups))
    docs = Counter(p for r in rows for p in set(r[2]))
    most = {}
    for (i, _), n in docs.items():
        most[i] = max(most.get(i, 0), n)
    return [
        (len(x), len(y), len(g), len(links), sum(docs[p] == most[p[0]] for p in links), sum(docs[p] for p in links), hashlib.sha256(";".join(g).encode()).hexdigest() if x else "")
        for x, y, links, g in rows
    ]


NAMES = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def odd_texts():
    rnd = random.Random(5)
    pool = ["a", "B", " ", " ", "  ", "\n", "\t", "\n ", "é", "ß", "漢字", "🙂", "'s", "12", "½", "\xa0", "\x85", "\x1c", "<|endoftext|>", "<s>", "</s>", "<0x41>", "<unk>", "...", "the", "aaaa", "\x00", "ﷺ", "▁", "​", "Hello", "world"]
    made = ["".join(rnd.choice(pool) for _ in range(rnd.randrange(30))) for _ in range(150)]
    return [None, "", " ", "  ", "a", " a", "a ", "x" * 3000, "ab" * 1000, " " * 500, *made, *made[:20]]


def test_equals_offsets(spark, libraries):
    texts = odd_texts()
    df = spark.createDataFrame([(k, t, "clash") for k, t in enumerate(texts)], "doc_id long, text string, a string").repartition(3)  # three blocks
    got = {r["id"]: tuple(r[n] for n in NAMES) for r in al.align_documents(df, *vocabularies()).collect()}
    want = slow(texts, libraries)
    for k, t in enumerate(texts):
        assert got[k] == want[k], repr(t)


def test_forgetting_changes_nothing(libraries, monkeypatch):
    texts = [t or "" for t in odd_texts()]
    once = al.Aligner(*vocabularies())
    whole = [once.block([t])[0][0][:5] for t in texts]
    monkeypatch.setattr(al, "KEPT_CHARS", 0)
    assert [once.block([t])[0][0][:5] for t in texts] == whole


def test_transducer_refuses_other_bytes():
    t = al.Transducer([b"ab", b"c", b"d"], [b"a", b"bc", b"x"])
    assert t.align([0, 1], [0, 1]) == ([(2, 2)], [(0, 0), (0, 1), (1, 1)])
    assert t.align([0, 1], [0, 2]) is None and t.align([0], [0, 1]) is None and t.align([0, 1, 2], [0, 1]) is None
    assert t.align([0, 1], [0]) is None and t.align([], []) == ([], [])


def test_odd_tables(spark):
    df = spark.createDataFrame([(None, "a b"), (1, None), (1, "a b"), (1, "a b")], "doc_id long, text string")
    assert al.align_documents(df.limit(0), *vocabularies()).collect() == []
    got = sorted((r["id"] is None, r["n_a"], r["n_best"], r["count_sum"]) for r in al.align_documents(df, *vocabularies()).collect())
    assert got == [(False, 0, 0, 0), (False, 2, 2, 6), (False, 2, 2, 6), (True, 2, 2, 6)]


def test_query(spark, libraries):
    docs = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()
    want = slow([r["text"] for r in docs], libraries)
    got = {r["doc_id"]: tuple(r[n] for n in NAMES) for r in op13_alignment(spark, SF).collect()}
    assert got == {r["doc_id"]: w for r, w in zip(docs, want, strict=True)}
