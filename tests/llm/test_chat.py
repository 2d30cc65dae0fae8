import hashlib
import random

import pytest

from claimlake.llm import chat as C

BITS = [*C.CONTROLS, "\\", "\\\\", "<", "[", "]", " ", "/", "INST]", "s>", "é", "\n", "", "x", ""]


def turns_of(rng, n, roles=("user", "assistant", "system")):
    return [(rng.choice(roles), "".join(rng.choice(BITS) for _ in range(rng.randint(0, 7)))) for _ in range(n)]


def test_escapes_and_parsing_are_exact():
    rng = random.Random(1)
    for _ in range(2000):
        turns = turns_of(rng, rng.randint(0, 6), ("user", "assistant", "system", "tool", "a]b", "", "\\"))
        assert C.parse(C.instruct_template(turns)) == turns
        for _, t in turns:
            assert C.unescape(C.escape(t)) == t and not any(c in C.escape(t) for c in C.CONTROLS)


@pytest.mark.parametrize("whole", [4096, 4])
def test_blocks_equal_one_rendering(monkeypatch, whole):
    monkeypatch.setattr(C, "WHOLE", whole)
    rng = random.Random(2)
    for _ in range(200):
        turns = turns_of(rng, rng.randint(1, 12))
        state, out = C.Rendering(C.instruct_template), ""
        for k in range(0, len(turns), 3):
            text, spans = state.block(turns[k : k + 3])
            for (_, t), (_, _, a, b) in zip(turns[k : k + 3], spans, strict=True):
                assert C.unescape(text[a:b]) == t
            out += text
        assert out == C.instruct_template(turns)


def test_templates_that_rewrite_history_are_refused():
    def ends(turns):
        return "".join(f"{r}:{t}\n" for r, t in turns) + "<end>"

    def only_last(turns):
        return "".join(f"{r}:{t if k == len(turns) - 1 else '...'}\n" for k, (r, t) in enumerate(turns))

    for template in (ends, only_last):
        with pytest.raises(C.RewritesHistory):
            C.Rendering(template).block([("user", "a"), ("assistant", "b")])


def test_templates_that_look_far_back_are_rendered_in_full():
    def numbered(turns):
        return "".join(f"{k} {r}: {t}\n" for k, (r, t) in enumerate(turns))

    turns = [("user", f"t{k}") for k in range(12)]
    state = C.Rendering(numbered)
    out = "".join(state.block(turns[k : k + 4])[0] for k in range(0, 12, 4))
    assert out == numbered(turns)


@pytest.mark.parametrize("whole", [4096, 4])
def test_no_result_hangs_on_the_number_of_turns(monkeypatch, whole):
    """Templates of unknown reach are rendered in full and false statements refused, at any length."""
    monkeypatch.setattr(C, "WHOLE", whole)

    def numbered(turns):
        return "".join(f"{k} {r}: {t}\n" for k, (r, t) in enumerate(turns))

    def speakers(turns):  # whether a role spoke before, however long ago
        return "".join(f"{'again ' if r in [x for x, _ in turns[:k]] else ''}{r}: {t}\n" for k, (r, t) in enumerate(turns))

    def third(turns):
        return "".join(f"{turns[k - 3][1] if k >= 3 else ''}>{t}\n" for k, (_, t) in enumerate(turns))

    turns = [("system" if k in (0, 10) else "user", f"t{k}") for k in range(16)]

    def rendered(template):
        state = C.Rendering(template)
        return "".join(state.block(turns[k : k + 2])[0] for k in range(0, len(turns), 2))

    for template in (numbered, speakers, third):
        assert rendered(template) == template(turns)
    third.looks_back = 3
    assert rendered(third) == third(turns)
    numbered.looks_back = 1
    with pytest.raises(ValueError, match="looks further back"):
        rendered(numbered)


def test_digests(spark, monkeypatch):
    monkeypatch.setattr(C, "BLOCK", 4)
    rng = random.Random(5)
    rows = []
    for c in [*range(25), None]:
        for k, (r, t) in enumerate(turns_of(rng, rng.randint(1, 9))):
            rows.append((c, k, r, t))
    rows += [(50, 0, "user", None), (50, 1, None, "x"), (51, 0, "assistant", "b"), (51, 0, "assistant", "a"), (51, 0, "assistant", "a"), (52, k := 0, "user", "y" * 100_000)]
    rows += [(60, k, "user" if k % 2 == 0 else "assistant", f"turn {k}") for k in range(300)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 AS block", "2 AS offset", "3 AS spans").repartition(4)
    got = {r["conv_id"]: r for r in C.digests(C.format_conversations(df)).collect()}
    assert len(got) == 30
    for c, r in got.items():
        own = sorted(((k, x or "", t or "") for i, k, x, t in rows if i == c))
        loss = "".join(t for _, x, t in own if x == "assistant")
        assert r["n_turns"] == len(own)
        assert r["turns_sha256"] == hashlib.sha256("".join(f"{x}\n{t}\n" for _, x, t in own).encode()).hexdigest()
        assert (r["loss_chars"], r["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert r["formatted_chars"] == len(C.instruct_template([(x, t) for _, x, t in own]))


def test_empty_table(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert C.digests(C.format_conversations(df)).count() == 0
