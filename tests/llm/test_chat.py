from __future__ import annotations

import hashlib
import random

from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidewater.llm import chat

PIECES = [*"<s>/\\[]|aü\n ", "</s>", "<s>", "[user]", "\\</s>"]
TEXTS = st.lists(st.sampled_from(PIECES), max_size=20).map("".join)


@given(st.lists(st.tuples(TEXTS, TEXTS, st.booleans()), max_size=6))
def test_parse_is_the_inverse_of_render(turns):
    text, repeated, loss = chat.render(turns)
    assert [(r, t) for r, t, *_ in chat.parse(text)] == [(r, t) for r, t, _ in turns]
    assert repeated == sum(not own for *_, own in turns)
    assert [chat.unescape(text[a:b]) for a, b in loss] == [t for r, t, own in turns if own and r == "assistant"]


def brute(rows):
    low = lambda x: (x is not None, x)
    out = []
    for conv in {r[0] for r in rows}:
        turns = [(r[2] or "", r[3] or "") for r in sorted((r for r in rows if r[0] == conv), key=lambda r: (low(r[1]), r[2] or "", r[3] or ""))]
        said = "".join(f"{r}\n{t}\n" for r, t in turns)
        loss = "".join(t for r, t in turns if r == "assistant")
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        out.append((conv, len(turns), sha(said), len(loss), sha(loss)))
    return sorted(out, key=repr)


def conversations():
    random.seed(4)
    rows = [(None, 1, "user", "a"), (None, 2, "assistant", None), (3, None, None, None), (3, 1, "assistant", "</s>" * 3000)]
    rows += [(4, 0, "system", "be kind"), *[(4, k, "user" if k % 2 else "assistant", f"turn {k} " * (k % 7)) for k in range(1, 300)]]
    rows += [(5, 1, "user", "same"), (5, 1, "user", "same"), (5, 1, "assistant", "tie"), (6, 0, "system", "long " * 2000), (6, 1, "assistant", "x")]
    rows += [(i, k, random.choice(["user", "assistant", "to]ol"]), "w " * random.randint(0, 900)) for i in range(7, 12) for k in range(9)]
    return rows


def test_all_turns_once_and_history_masked(spark):
    rows = conversations()
    turns = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, window string")
    made = chat.windows(turns, F.ceil(F.coalesce(F.octet_length("text"), F.lit(0)) / 4))
    got = chat.digests(made).select("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256").collect()
    assert sorted(map(tuple, got), key=repr) == brute(rows)
    long = {r["window"]: r for r in made.where("conv_id = 4").collect()}
    assert len(long) > 2
    for number, row in long.items():
        said = chat.parse(row["text"])
        assert said[0][:2] == ("system", "be kind")
        assert (row["n_repeated"] > 1) == (number > 0)
        if number:
            before = [t[1] for t in chat.parse(long[number - 1]["text"])]
            assert [t[1] for t in said[1 : row["n_repeated"]]] == before[-(row["n_repeated"] - 1) :]
    for row in made.where("conv_id in (4, 7)").collect():
        own = chat.parse(row["text"])
        if len(own) - row["n_repeated"] > 1:
            assert len(row["text"]) < 4 * (chat.SHARE + chat.HISTORY) + 4 * 900


def test_no_turns(spark):
    turns = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.digests(chat.windows(turns, F.length("text"))).count() == 0
