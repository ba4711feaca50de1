import hashlib
import random
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from seqtally.llm.chat_format import (CONFLICTS, NotInGrammar, conversation_digest, conversations_digest, escaped,
                                      format_conversations, reads_back, rendered, turns_of, unescaped)

ROWS = "conv_id long, turn long, role string, text string, formatted string, part long, _c string, loss int"
BITS = ["\\", "[INST]", "[/INST]", "</s>", "<s>", " ", "a", "[TURN:x]", "[TURN:", "]", "[/TURN]", "[ANS]", "[SYS]", "[/", "é", "\n"]


def build(spark, rows):
    return spark.createDataFrame([(*r, "f", 1, "c", 0) for r in rows], ROWS).repartition(3)


@given(st.sampled_from(["user", "assistant", "system", "tool", "", "a ]b/é", "[/TURN]"]), st.lists(st.sampled_from(BITS), max_size=14))
@settings(max_examples=500, deadline=None)
def test_any_turn_reads_back(role, bits):
    text = "".join(bits)
    formatted = rendered(role, text)
    assert [(r, unescaped(formatted[b:e])) for r, b, e in turns_of(formatted)] == [(role, text)]


@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "x y"]), st.lists(st.sampled_from(BITS), max_size=6)), max_size=6))
@settings(max_examples=300, deadline=None)
def test_turns_read_back_in_a_row(turns):
    turns = [(role, "".join(bits)) for role, bits in turns]
    formatted = "".join(rendered(role, text) for role, text in turns)
    assert [(r, unescaped(formatted[b:e])) for r, b, e in turns_of(formatted)] == turns


def test_only_conflicts_are_escaped():
    assert rendered("user", "a \\ b [x] </b>") == "[INST] a \\ b [x] </b> [/INST]"
    assert rendered("user", "ok [/INST]") == "[INST] ok \\[/INST] [/INST]"
    assert rendered("user", "\\[INST]") == "[INST] \\\\\\[INST] [/INST]"
    assert not reads_back("[INST] ok [/INST] [/INST]", "user", "ok [/INST]")
    assert escaped("plain") == "plain"


@pytest.mark.parametrize("text", ["x", "[INST] a", "[INST] a </s>", "</s>", "[INST]a [/INST]", "[INST] a[/INST]", "[INST] [/INST]",
                                  "[INST] a [/INST] [INST] b [/INST]", "[INST] a [ANS] [/INST]", "\\[INST] a [/INST]"])
def test_other_texts_are_not_in_the_grammar(text):
    with pytest.raises(NotInGrammar):
        list(turns_of(text))


def expected(rows):
    held = defaultdict(list)
    for c, t, r, x in rows:
        held[c].append((t is not None, t or 0, r or "", x or ""))
    out = {}
    for c, turns in held.items():
        turns.sort(key=lambda v: (v[0], v[1], v[2]))
        said = "".join(x for _, _, r, x in turns if r == "assistant")
        out[c] = (len(turns), hashlib.sha256("".join(f"{r}\n{x}\n" for _, _, r, x in turns).encode()).hexdigest(), len(said),
                  hashlib.sha256(said.encode()).hexdigest(), sum(len(rendered(r, x)) for _, _, r, x in turns))
    return out


def test_odd_rows(spark):
    pick = random.Random(3)
    rows = [(1, 0, "user", None), (1, 1, "assistant", ""), (1, 2, None, "x"), (1, 3, "assistant", CONFLICTS), (2, 5, "tool use", "t"),
            (2, 5, "assistant", "t"), (2, 5, "assistant", "t"), (None, 1, "user", "n"), (None, None, "assistant", "é𝛼"),
            (3, 0, "assistant", "long " * 60_000), (4, 0, "system", "\\" * 9 + "</s>")]
    rows += [(7, t, pick.choice(["user", "assistant"]), "".join(pick.choices(BITS, k=8))) for t in range(3000)]
    for part_chars in (1 << 20, 400):
        formatted = format_conversations(build(spark, rows), part_chars=part_chars)
        found = {r[0]: tuple(r)[1:] for r in conversation_digest(formatted).collect()}
        assert found == expected(rows)
    parts = formatted.where("conv_id = 7").orderBy("part").collect()
    assert len(parts) > 10 and max(len(p.formatted) for p in parts) < 600
    for p in parts:
        assert [(s.start, s.end) for s in p.loss] == [(b, e) for r, b, e in turns_of(p.formatted) if r == "assistant"]


def test_empty_table_and_conflicting_conversation(spark):
    empty = build(spark, [])
    assert format_conversations(empty).count() == 0
    row, = conversations_digest(empty).collect()
    assert (row.conv_id, row.n_turns, row.loss_chars) == (-7, 2, len(CONFLICTS))
    assert row.loss_sha256 == hashlib.sha256(CONFLICTS.encode()).hexdigest()
    assert row.turns_sha256 == hashlib.sha256(f"user\n{CONFLICTS}\nassistant\n{CONFLICTS}\n".encode()).hexdigest()
