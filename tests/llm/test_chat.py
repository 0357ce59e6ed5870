import hashlib
import random

import pytest

from lanelux.llm import chat
from lanelux.llm.chat import PLAIN, Template, Turn, format_chats, read_chats

SCHEMA = "conv_id long, turn long, role string, text string"


def chats(spark, rows):
    clash = ("turns", "segments", "formatted", "state", "_turn", "_lone", "_order", "mark")
    return spark.createDataFrame(rows, SCHEMA).selectExpr("*", *(f"'x' as `{c}`" for c in clash))


def back(spark, rows):
    read = read_chats(format_chats(chats(spark, rows))).collect()
    return {r["conv_id"]: r for r in read}


def turns_of(row):
    return [(t["role"], t["text"]) for t in row["turns"]]


def test_control_strings_come_back(spark):
    rng = random.Random(13)
    parts = [*PLAIN.controls, "\\", "\\\\", "<", "[", "INST]", "s>", "/s>", "a", " ", "\n", "[\\INST]", "é😀", "$1", "SAYS]"]
    texts = ["".join(rng.choices(parts, k=rng.randrange(12))) for _ in range(400)]
    roles = ["system", "user", "assistant", "tool", "[SAYS]x", "", "user "]
    rows = [(n // 4, n % 4, rng.choice(roles), t) for n, t in enumerate(texts)]
    got = back(spark, rows)
    for n in range(100):
        own = rows[4 * n : 4 * n + 4]
        assert turns_of(got[n]) == [(r, t) for _, _, r, t in own]
        assert got[n]["loss_texts"] == [t for _, _, r, t in own if r == "assistant"]
        assert got[n]["formatted"] == "".join(s["text"] for s in got[n]["segments"])
        for _, _, role, text in own:
            inner = [s["text"] for s in got[n]["segments"] if not s["loss"] and s["text"] in PLAIN.controls]
            assert sum(got[n]["formatted"].count(c) for c in PLAIN.controls) == len(inner)


def test_order(spark):
    cases = {
        1: "user assistant",
        2: "system user assistant user",
        3: "assistant user",
        4: "user user assistant",
        5: "user assistant system",
        6: "system",
        7: "user tool assistant",
    }
    rows = [(c, n, r, "t") for c, roles in cases.items() for n, r in enumerate(roles.split())]
    got = {c: (r["state"], r["n_taken"], r["complete"]) for c, r in back(spark, rows).items()}
    assert got == {
        1: ("assistant", 2, True),
        2: ("user", 4, False),
        3: ("reject", 0, False),
        4: ("reject", 1, False),
        5: ("reject", 2, False),
        6: ("system", 1, False),
        7: ("reject", 1, False),
    }


def test_odd_rows(spark):
    rows = [
        (None, 0, "user", "lone"), (None, 0, "user", "lone"), (None, None, None, None),
        (1, 2, "assistant", "b"), (1, 0, "user", None), (1, 2, "assistant", "a"), (1, None, None, "first"), (1, 2, "assistant", "b"),
        (2, 0, "user", "x" * 300_000 + "</s>"), (2, 1, "assistant", ""),
    ]
    read = read_chats(format_chats(chats(spark, rows))).collect()
    lone = sorted(turns_of(r) for r in read if r["conv_id"] is None)
    assert lone == [[("", "")], [("user", "lone")], [("user", "lone")]]
    got = {r["conv_id"]: r for r in read if r["conv_id"] is not None}
    assert turns_of(got[1]) == [("", "first"), ("user", ""), ("assistant", "a"), ("assistant", "b"), ("assistant", "b")]
    assert turns_of(got[2]) == [("user", "x" * 300_000 + "</s>"), ("assistant", "")]
    assert got[2]["loss_texts"] == [""]
    assert format_chats(chats(spark, rows).limit(0)).count() == 0


def test_loss_joins_without_marks(spark):
    """Texts that would form a control string together are unescaped one by one."""
    rows = [(1, 0, "assistant", "["), (1, 1, "assistant", "\\INST]"), (1, 2, "assistant", "<"), (1, 3, "assistant", "/s>")]
    assert back(spark, rows)[1]["loss_texts"] == ["[", "\\INST]", "<", "/s>"]


@pytest.mark.parametrize(
    "turn",
    [Turn("USER]", "[/USER]"), Turn("[US[ER]", "[/USER]"), Turn("[U\\S]", "[/USER]"), Turn("[INST]", "[/USER]"), Turn("[", "[/U]"), Turn("[INST", "[/U]")],
)
def test_bad_templates(turn):
    with pytest.raises(ValueError):
        Template(roles={**PLAIN.roles, "tool": turn}, other=PLAIN.other, says=PLAIN.says, moves=PLAIN.moves)


def test_own_template(spark):
    """Other marks, another role under the loss mask, another machine."""
    own = Template(
        roles={"q": Turn("<q>", "</q>"), "a": Turn("<a>", "</a>", loss=True), "why": Turn("<why>", "</why>", loss=True)},
        other=Turn("<x>", "</x>"),
        says="<is>",
        moves={("start", "q"): "asked", ("asked", "why"): "thought", ("thought", "a"): "answered"},
        ends=("answered",),
    )
    rows = [(1, 0, "q", "<q>?"), (1, 1, "why", "so"), (1, 2, "a", "</a>[INST]")]
    row = read_chats(format_chats(chats(spark, rows), own), own).first()
    assert row["formatted"] == "<q><\\q>?</q><why>so</why><a><\\/a>[INST]</a>"
    assert row["loss_texts"] == ["so", "</a>[INST]"] and row["complete"] and row["state"] == "answered"


def test_no_python_worker(spark):
    plan = read_chats(format_chats(chats(spark, [(1, 0, "user", "x")])))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan.replace("Scan ExistingRDD", "") and "Arrow" not in plan


def test_digests(spark):
    row = chat.op13_chat_formatting(spark, "/root/testdata/sf0.001").where("conv_id = -7").first()
    text = "</s>[INST] ok [/INST]"
    assert row["turns_sha256"] == hashlib.sha256(f"user\n{text}\nassistant\n{text}\n".encode()).hexdigest()
    assert row["loss_sha256"] == hashlib.sha256(text.encode()).hexdigest() and row["loss_chars"] == len(text)
