import hashlib
import random

import pytest
from pyspark.sql import functions as F

from tidewell.llm import chat
from tidewell.llm.q08_chat import EXTRA, op8_chat


def made():
    rnd = random.Random(8)
    bits = ["<", "|", "\\", ">", "<|end|>", "<|user|>", "<\\|", "<\\\\|x", "hi ", "é🙂", "\n", "</s>", "[INST]"]
    rows = []
    for c in range(40):
        k = 0
        if rnd.random() < 0.4:
            rows.append((c, k, "system", rnd.choice(["be kind", "<|system|>"])))
            k += 1
        for t in range(rnd.randrange(1, 9)):
            rows.append((c, k + t, rnd.choice(["user", "assistant", "assistant", "|>", "<|", "a|\\>"]), "".join(rnd.choice(bits) for _ in range(rnd.randrange(60))) if rnd.random() < 0.95 else None))
    rows += [(None, 0, "user", "x"), (50, None, None, "y"), (50, 1, "assistant", None), (51, 0, "assistant", "same"), (51, 0, "assistant", "same")]
    return rows


@pytest.mark.parametrize(("budget", "history"), [(1024, 2), (5, 1), (30, 0), (1, 3)])
def test_round_trip(spark, budget, history):
    rows = made()
    df = spark.createDataFrame([(*r, "w") for r in rows], "conv_id long, turn long, role string, text string, window string")
    formatted = chat.windows(chat.conversations(df), budget, history).cache()
    got = {r["id"]: r for r in chat.read_back(formatted).collect()}
    want = {}
    for c, t, role, text in rows:
        want.setdefault(c, []).append((t if t is not None else -1, role or "none", text or ""))
    assert set(got) == set(want)
    for c, turns in want.items():
        turns.sort()
        assert [(t["role"], t["text"]) for t in got[c]["turns"]] == [x[1:] for x in turns]
        assert got[c]["loss"] == "".join(x[2] for x in turns if x[1] == "assistant")
    for r in formatted.collect():
        if len(turns := sorted(want[r["id"]])) and turns[0][1] == "system":
            assert r["text"].startswith("<|system|>")
    formatted.unpersist()


def measure(text):
    import regex

    return len(regex.findall(r"[\p{L}\p{N}]+|[^\s\p{L}\p{N}]", text))


@pytest.mark.parametrize("seed", range(6))
def test_budget_holds(spark, seed):
    """Random budgets and histories: a window exceeds its budget only with a turn that fits beside no system turn, and then holds no history."""
    rnd = random.Random(seed)
    rows = []
    for c in range(25):
        n = rnd.randrange(1, 25)
        rows += [(c, k, "system" if k == 0 and c % 3 == 0 else "assistant" if k % 2 else "user", "w " * rnd.choice([0, 1, 5, 10, 30, 90])) for k in range(n)]
    budget, history = rnd.choice([20, 35, 60, 120, 400]), rnd.randrange(5)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    size = {(c, k + 1): measure(f"<|{r}|>{t}<|end|>") for c, k, r, t in rows}
    role = {(c, k + 1): r for c, k, r, _ in rows}
    several = 0
    for w in chat.windows(chat.conversations(df), budget, history).collect():
        c, first, last = w["id"], w["first"], w["last"]
        system = role[c, 1] == "system" and first > 1
        assert w["tokens"] == measure(w["text"])
        shown = w["text"].count("<|end|>") - (last - first + 1)
        h = shown - system
        assert 0 <= h <= history and first - h >= 1 + (role[c, 1] == "system" and first > 1)
        assert w["over"] == (w["tokens"] > budget)
        if w["over"]:
            assert first == last and h == 0
        else:  # neither another turn nor, within half of the room, more history would fit
            room = budget - system * size[c, 1]
            nxt = size.get((c, last + 1))
            assert nxt is None or w["tokens"] + nxt > budget
            more = first - h - 1
            if h < history and more > (role[c, 1] == "system"):
                old = sum(size[c, k] for k in range(more, first))
                assert old > room // 2 or old + size[c, first] > room
        several += w["window"] > 0
    assert several


def test_null_ids_form_one_conversation(spark):
    df = spark.createDataFrame([(None, 0, "user", "a"), (None, 0, "user", "a"), (1, 0, "user", "b")], "conv_id long, turn long, role string, text string")
    assert sorted((str(r["id"]), len(r["turns"])) for r in chat.conversations(df).collect()) == [("1", 1), ("None", 2)]


def test_query(spark, tmp_path):
    df = spark.createDataFrame([(3, 0, "user", "q"), (3, 1, "assistant", "a<|end|>")], "conv_id long, turn long, role string, text string")
    df.write.parquet(str(tmp_path / "conversations.parquet"))
    got = {r["conv_id"]: r for r in op8_chat(spark, str(tmp_path)).collect()}
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    assert got[3]["turns_sha256"] == sha("user\nq\nassistant\na<|end|>\n") and got[3]["loss_sha256"] == sha("a<|end|>") and got[3]["loss_chars"] == 8
    assert got[-7]["turns_sha256"] == sha(f"user\n{EXTRA}\nassistant\n{EXTRA}\n") and got[-7]["n_turns"] == 2
    empty = chat.read_back(chat.windows(chat.conversations(df.filter(F.lit(False)))))
    assert empty.collect() == []


def test_no_window_of_the_query_is_over_its_budget(spark):
    from tidewell.llm.common import read_table
    from tidewell.llm.q08_chat import BUDGET, HISTORY

    found = chat.windows(chat.conversations(read_table(spark, "/root/testdata/sf0.01", "conversations")), BUDGET, HISTORY)
    assert found.filter("over").count() == 0 and found.filter("window > 0").count() > 20
