import random
import re

from tidewell.llm import pii

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(d):
    return sum(sum(divmod(2 * int(c), 10)) if i % 2 else int(c) for i, c in enumerate(d[::-1])) % 10 == 0


def base(text):
    out = []
    for kind, p in PATTERNS.items():
        for m in re.finditer(p, text or ""):
            d = re.sub("[^0-9]", "", m[0])
            ok = {"email": True, "ip": all(int(x) <= 255 for x in m[0].split(".")) if kind == "ip" else 0, "card": 16 <= len(d) <= 19 and luhn(d), "phone": 8 <= len(d) <= 15}[kind]
            if ok:
                out.append((kind, m.start(), m.end()))
    return out


def test_base_matches_brute_force(spark):
    rnd = random.Random(9)
    bits = ["a", "é", "🙂", "@", ".", "-", " ", "+", "(", ")", "1", "9", "255", "0", "4111 1111 1111 1111", "4012888888881881", "x.y@host-1.org", "a@b.c_d@e.fr", "1.2.3.4", "+49 (30) 123456", "\n", "%", "_", "256.1.1.1", "4111-1111-1111-1111 2", "0001.2.3.4"]
    texts = ["".join(rnd.choice(bits) for _ in range(rnd.randrange(30))) for _ in range(500)] + [None, "", "1" * 20000, "a" * 20000 + "@", "1.1" * 3000, "+1" + " " * 5000]
    df = spark.createDataFrame([(k, t, "b") for k, t in enumerate(texts)], "doc_id long, text string, base string")
    for r in pii.find(df).collect():
        assert [tuple(s) for s in r["base"]] == base(texts[r["id"]]), repr(texts[r["id"]])[:200]
        for s in r["added"]:
            assert all(s["end"] <= a or b <= s["start"] for _, a, b in base(texts[r["id"]]))


def test_added_spans_and_redaction(spark):
    texts = [f"Please call tel: (499) 555-65{k:02d}. Thank you." for k in range(30)] + [f'token = "1eb9c654e721b4f812088970e66a6345cee33d{k:02d}" end.' for k in range(30)]
    texts += [f"the cat sat on version 10 {k} mats in 1999 and chapter 12" for k in range(60)] + ["write x@y.org or +49 30 1234567!", None]
    df = spark.createDataFrame([(t, k) for k, t in enumerate(texts)], "text string, doc_id long")
    got = {r["doc_id"]: r["text"] for r in pii.redact(df).collect()}
    assert got[0] == "Please call tel: [PHONE]. Thank you." and got[30] == 'token = "[SECRET]" end.'
    assert got[60] == texts[60] and got[120] == "write [EMAIL] or [PHONE]!" and got[121] is None


def test_empty_table(spark):
    assert pii.find(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_reliabilities():
    """Votes of a labeler that follows the truth outweigh those of one that doesn't."""
    code = lambda v: sum(x * 3 ** (pii.LABELERS - 1 - j) for j, x in enumerate(v))
    chance = pii.estimate({code([2, 2, 2, 1, 1, 1]): 50, code([0, 0, 1, 1, 1, 1]): 50, code([2, 2, 1, 1, 1, 1]): 20, code([0, 0, 1, 0, 1, 1]): 20})
    assert chance[code([2, 2, 1, 1, 1, 1])] > 0.9 > 0.1 > chance[code([0, 0, 1, 1, 1, 1])]


def test_long_runs_go_whole(spark):
    """No length ends a span early: long tokens, long local parts, many parts of a domain."""
    token = "Ab3" * 100
    texts = [f'key = "{token}" x', f"write to {'a' * 100}(at) one (dot) two (dot) three.four (dot) five (dot) org now", *[f'key = "{"Zq7" * (8 + k)}" x' for k in range(20)], *[f"mail: b{k} [at] c{k} [dot] com" for k in range(20)]]
    got = {r["doc_id"]: r["text"] for r in pii.redact(spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")).collect()}
    assert got[0] == 'key = "[SECRET]" x' and got[1] == "write to [EMAIL] now"


def planted(rnd):
    """A text with personal data of a further kind, and its kind and span."""
    d = lambda n: "".join(rnd.choice("0123456789") for _ in range(n))
    name = f"{rnd.choice(pii.GIVEN)} {rnd.choice(['Smith', 'Müller', 'Duponta', 'Garcia', 'Okafor'])}"
    kind, before, what, after = rnd.choice(
        [
            ("email", "You can write to ", f"x{d(3)} (at) host{d(2)} (dot) org", " about it."),
            ("phone", "Please call tel: ", f"({rnd.randrange(200, 999)}) 555-{d(4)}", " today."),
            ("account", "Pay to IBAN ", f"DE{d(2)} {d(4)} {d(4)} {d(4)} {d(4)} {d(2)}", " soon."),
            ("secret", "token = ", "".join(rnd.choice("abcdefGHIJKL0123456789") for _ in range(40)), " ends."),
            ("person", "The form is signed by ", name, ", as it seems."),
            ("person", "Yesterday ", f"Dr. {name}", " told us."),
            ("address", f"{name} lives at ", f"{d(2).lstrip('0') or '7'} {rnd.choice(['Baker', 'High', 'Long Hill'])} Street", ", London."),
            ("birth", "The patient was born on ", f"{rnd.randrange(1, 29)}.{rnd.randrange(1, 13)}.19{d(2)}", " there."),
            ("id", "Her passport number ", f"{d(9)}", " was lost."),
        ]
    )
    text = before + what + after
    return text, kind, len(before), len(before) + len(what)


def test_recall_and_precision_of_added_spans(spark):
    rnd = random.Random(12)
    want, texts = {}, []
    for k in range(900):
        if k % 3 == 0:
            text, kind, a, b = planted(rnd)
            want[k] = (kind, a, b)
        else:
            text = rnd.choice([f"In chapter {k} of version 2.{k} there were {k * 977} people on 12.03.20{k % 100:02d}.", "Nothing to see here at all.", f"Order no {10**7 + k} left the Alice Springs depot in 1999."])
        texts.append(text)
    rows = pii.find(spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")).collect()
    spans = {r["id"]: {tuple(s) for s in r["added"]} for r in rows}
    by_kind = {}
    for k, w in want.items():
        by_kind.setdefault(w[0], []).append(w in spans[k])
    recall = {kind: sum(x) / len(x) for kind, x in by_kind.items()}
    assert min(recall.values()) >= 0.9, recall
    wrong = [(texts[k], s) for k, s in spans.items() if k not in want and s]
    assert len(wrong) <= 0.02 * len(texts), wrong[:5]


def test_query(spark, tmp_path):
    import hashlib

    from tidewell.llm.q02_pii import op2_pii

    rnd = random.Random(2)
    rows = [(k, planted(rnd)[0] + f" a{k}@b.org 1.2.3.{k} +49 30 123456{k}") for k in range(60)] + [(100, None), (101, "")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    for r in op2_pii(spark, str(tmp_path)).collect():
        spans = base(dict(rows)[r["doc_id"]])
        assert [r[f"n_{k}"] for k in PATTERNS] == [sum(s[0] == k for s in spans) for k in PATTERNS]
        said = ",".join(":".join(map(str, s)) for s in spans)
        assert r["base_sha256"] == hashlib.sha256(said.encode()).hexdigest()
        parts = [x.split(":") for x in r["spans"].split(",") if x]
        assert {tuple(x) for x in parts} >= {tuple(map(str, s)) for s in spans}
        assert parts == sorted(parts, key=lambda x: (pii.KINDS.index(x[0]), int(x[1])))


#: Names, streets and cues, most of which stand in no list of the library.
OTHERS = [
    ("My name is {} and I was born on 03.05.1981.", ["Xiulan Nguyen", "Mohammed Al-Farsi", "Svetlana Petrova", "Priya Raghavan", "Giulia Ferrari", "Yuki Tanaka", "Siobhan O'Neil", "Jan van der Berg", "Oluwaseun Adeyemi", "Bo Ek"]),
    ("The contract was signed by {} on Monday.", ["Ngozi Eze", "Tomasz Kowalczyk", "Ayşe Yılmaz", "Anneke Visser", "Dmitri Volkov"]),
    ("Yesterday {} came to the office.", ["Dr. Xiulan Nguyen", "Mrs Okonkwo", "Herr Lindqvist", "Prof. Haruki Sato"]),
    ("Dear {}, thank you for your letter.", ["Leila Haddad", "Piotr Nowak"]),
]
STREETS = ["12 Kestrel Close Road", "5 rue de la Paix", "calle Mayor 14", "Lindenallee 7, 10115 Berlin", "221 Juniper Avenue", "8 bis avenue Foch"]


def test_people_and_streets_beyond_the_lists(spark):
    want, texts = {}, []
    for cue, names in OTHERS:
        for n in names:
            want[len(texts)] = ("person", cue.index("{}"), cue.index("{}") + len(n))
            texts.append(cue.format(n))
    for x in STREETS:
        want[len(texts)] = ("address", len("She lives at "), len("She lives at ") + len(x))
        texts.append(f"She lives at {x}, as we know.")
    clean = ["Emma Stone was great in La La Land.", "See commit 3f786850e387550fdab836ed7e6dc881de23001b for it.", "The White House and the Eiffel Tower are old.", "In version 10.2 of Open Office the menu is new.", "He read Moby Dick in New York."]
    texts += [f"{t} Line {k}." for k in range(40) for t in clean]
    rows = pii.find(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    spans = {r["id"]: {tuple(x) for x in r["added"]} for r in rows}
    missed = [(texts[k], spans[k]) for k, w in want.items() if w not in spans[k]]
    assert len(missed) <= 0.1 * len(want), missed
    assert not [(texts[k], x) for k, x in spans.items() if k not in want and x]


def test_many_spans_in_a_long_text(spark):
    import time

    text = "write x@y.org or 1.2.3.4 now é " * 40_000
    began = time.time()
    got = pii.redact(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()[0]["text"]
    assert got == "write [EMAIL] or [IP] now é " * 40_000
    assert time.time() - began < 90
