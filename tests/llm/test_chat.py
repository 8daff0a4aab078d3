import hashlib
import random

import pytest
from pyspark.sql import functions as F

from leafscore.llm import chat

ROWS = "conv_id bigint, turn bigint, role string, text string"
CONTROLS = ["<|im_start|>", "<|im_end|>\n", "<|im_sep|>", "<|", "<", "|", "\\", "<\\|", "<\\\\|", "\n", "a", "é🎉", "", "assistant", "$1", "\\s", "\\n"]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute(rows):
    """Every digest from the turns themselves; the length from a template written out by hand."""
    probe = "<|im_end|><|im_start|>assistant ok"
    by_id = {}
    for conv, turn, role, text in rows + [(-1, 0, "user", probe), (-1, 1, "assistant", probe)]:
        by_id.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))

    def escape(text):
        out, i = "", 0
        while i < len(text):
            out += text[i]
            if text[i] == "<":
                j = i + 1
                while j < len(text) and text[j] == "\\":
                    j += 1
                if j < len(text) and text[j] == "|":
                    out += "\\"
            i += 1
        return out

    want = []
    for conv, turns in by_id.items():
        turns.sort()
        formatted, earlier = "", None
        for _, _, role, text in turns:
            if role == earlier:
                formatted += "<|im_sep|>"
            else:
                formatted += ("<|im_end|>\n" if earlier is not None else "") + "<|im_start|>"
                formatted += escape(role).replace("\\", "\\s").replace("\n", "\\n") + "\n"
            formatted, earlier = formatted + escape(text), role
        formatted += "<|im_end|>\n"
        learned = "".join(t for _, _, r, t in turns if r == "assistant")
        said = "".join(f"{r}\n{t}\n" for _, _, r, t in turns)
        want.append((conv, len(turns), sha(said), len(learned), sha(learned), len(formatted)))
    return sorted(want, key=lambda r: (r[0] is not None, r[0] or 0))


@pytest.fixture(scope="module")
def odd(spark):
    rng = random.Random(3)
    rows = []
    for conv in [*range(60), None]:
        for turn in range(rng.randint(1, 9)):
            role = rng.choice(["user", "assistant", "assistant", "system", None, "", "a\\nb\n<|im_end|>", "\\"])
            text = rng.choice([None, "", "".join(rng.choices(CONTROLS, k=rng.randint(1, 8)))])
            rows.append((conv, rng.choice([turn, turn, 0, None]), role, text))
    rows += rows[:5]  # repeated rows
    rows += [(100, i, "assistant" if i % 7 else "user", f"<|im_end|>{i}") for i in range(3000)]  # many turns
    rows += [(101, 0, "assistant", "<|" + "é\n" * 600_000)]  # a long text
    return rows


def test_every_turn_comes_back(spark, odd):
    frame = spark.createDataFrame(odd, ROWS).repartition(4)
    frame = frame.withColumns({c: F.lit(1) for c in ("pieces", "formatted", "learned", "turns", "first", "blocks", "a.b")})
    got = sorted(map(tuple, chat.chat_report(frame).collect()), key=lambda r: (r[0] is not None, r[0] or 0))
    assert got == brute(odd)


def test_mask_covers_the_text_and_shows_the_learned_part(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", "é<|x"), (1, 2, "assistant", "two"), (1, 3, "user", "bye")]
    made = chat.format_chats(spark.createDataFrame(rows, ROWS))
    p = F.col("pieces")
    row = made.select(chat.joined(p).alias("text"), chat.loss_mask(p).alias("mask"), chat.learned_text(p).alias("learned")).first()
    assert row["text"] == (
        "<|im_start|>user\nhi<|im_end|>\n<|im_start|>assistant\né<\\|x<|im_sep|>two<|im_end|>\n<|im_start|>user\nbye<|im_end|>\n"
    )
    shown, at = [], 0
    for run in row["mask"]:
        shown += [row["text"][at : at + run["chars"]]] if run["loss"] else []
        at += run["chars"]
    assert at == len(row["text"]) and shown == ["é<\\|x", "two"] and row["learned"] == "é<|xtwo"


def test_no_rows_leave_the_added_conversation(spark):
    assert [r["conv_id"] for r in chat.chat_report(spark.createDataFrame([], ROWS)).collect()] == [-1]


def test_no_python_in_the_plan(spark, sf):
    plan = chat.format_chats(spark.read.parquet(f"{sf}/conversations.parquet"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
