"""Chat formatting as an exact round trip, its masks against characters."""

import hashlib
import random

import numpy as np
from pyspark.sql import functions as F

from tarnwork.llm import chat
from tarnwork.llm.tokens import BYTE_BPE, vocabulary

SF = "/root/testdata/sf0.01"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def want(turns):
    said = "".join(t for r, t in turns if r == "assistant")
    return len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(said), sha(said)


def test_escapes_are_reversible():
    rng = random.Random(1)
    parts = ["<", "[", "\\", "/", "s>", "INST]", "<s>", "</s>", "[INST]", "[/INST]", "a", "\n", "<\\s>", "[\\\\/INST]"]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(9)))
        assert chat.unescape(chat.escape(text)) == text
        assert not any(x in chat.escape(text) for x in chat.CONTROLS)


def test_whole_table(spark):
    turns = {-1: [("user", chat.HOSTILE), ("assistant", chat.HOSTILE)]}
    for r in spark.read.parquet(f"{SF}/conversations.parquet").orderBy("conv_id", "turn").collect():
        turns.setdefault(r.conv_id, []).append((r.role, r.text or ""))
    rows = chat.op9_offset_aligned_chat(spark, SF).collect()
    assert {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in rows} == {k: want(v) for k, v in turns.items()}
    assert len(rows) == len(turns) and all(r.formatted_chars > r.loss_chars for r in rows)


def test_masks_cover_what_they_should():
    rng = random.Random(4)
    tool = chat.chat_tokenizer(vocabulary(BYTE_BPE))
    bits = ["hello", " ", "  ", "\n", "日本", "é", "😀", "<s>", "[/INST]", "\\", "it's", "12", "́"]
    for _ in range(150):
        turns = [(rng.choice(["user", "assistant", "system", "", "<s>"]), "".join(rng.choice(bits) for _ in range(rng.randrange(12)))) for _ in range(rng.randrange(1, 7))]
        text, spans = chat.render(turns)
        e = tool.encode(text, add_special_tokens=False)
        at = np.array(e.offsets).reshape(-1, 2)
        wanted = np.array([(a, b) for r, a, b in spans if r == "assistant"], np.int64).reshape(-1, 2)
        mask = chat.loss_mask(at[:, 0], at[:, 1], wanted)
        inside = set().union(*[range(a, b) for a, b in wanted.tolist()])
        for (a, b), m in zip(at.tolist(), mask):
            assert m == bool(inside & set(range(a, b))) and (not m or set(range(a, b)) <= inside)
        said = [chat.unescape(x) for x in chat.masked_text(text, at[:, 0], at[:, 1], mask, wanted)]
        assert said == [t for r, t in turns if r == "assistant"]
        assert chat.parse(text) == turns


def test_nulls_ties_repeats_and_no_rows(spark):
    rows = [(1, 0, "user", None), (1, 1, "assistant", "[\\INST] a"), (1, 1, "assistant", "[\\INST] a"), (1, None, None, "late"),
            (None, 0, "assistant", "nobody's"), (2, 5, "assistant", ""), (3, 0, "assistant", "long " * 20000), (4, 0, "user", "b"), (4, 0, "assistant", "a")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, ids string").toDF("conv_id", "turn", "role", "text", "TEXT")
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in chat.digests(chat.format_conversations(df)).collect()}
    assert got == {
        1: want([("user", ""), ("assistant", "[\\INST] a"), ("assistant", "[\\INST] a"), ("", "late")]), None: want([("assistant", "nobody's")]),
        2: want([("assistant", "")]), 3: want([("assistant", "long " * 20000)]), 4: want([("assistant", "a"), ("user", "b")]),
    }
    assert chat.format_conversations(df.where(F.lit(False))).collect() == []
