"""Template compiler, escaping and the exact round trip of conversations."""

import hashlib
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from almanac.llm import chat

SF = "/root/testdata/sf0.001"
pieces = st.lists(st.sampled_from([*"<|>\\[]/\n x", "<|im_end|>", "<|im_sep|>", "<|im_start|>", "<\\|im_end|>", "im_end|>", "</s>", "[INST]"]), max_size=12)


@settings(max_examples=300, deadline=None)
@given(pieces.map("".join), st.sampled_from([chat.CONTROLS, ("<s>", "</s>", "[INST]", "[/INST]")]))
def test_escape_is_reversible_and_leaves_no_control(text, controls):
    put, cut = chat.escaper(controls)
    assert cut(put(text)) == text
    assert not any(c in put(text) for c in controls)


def test_ambiguous_controls_are_refused():
    for bad in (("aa",), ("<a", "b<"), ("x",), ("<\\a",)):
        with pytest.raises(chat.TemplateError):
            chat.escaper(bad)


def test_language():
    t = chat.Template("{% set sep = ', ' %}{% for x in xs %}{% if loop.first %}[{% elif x == 2 %}two{% else %}{{ sep }}{% endif %}"
                      "{{ x ~ '!' }}{% if loop.last %}]{{ loop.index }}{% endif %}{% endfor %}{# note #}{{ 'a' | upper }}", ())
    assert t.render(xs=[1, 2, 3])[0] == "[1!two2!, 3!]3A"
    assert t.render(xs=[])[0] == "A"
    assert chat.Template("{{ a and not b or 'x' in c }}", ()).render(a=True, b=True, c=["x"])[0] == "True"
    assert chat.Template("{{ -1 + 3 - 1 }}{{ m['k'].z }}", ()).render(m={"k": {"z": None}})[0] == "1"


def test_constants_are_folded():
    t = chat.Template("a{{ 'b' ~ 1 + 1 }}{% if 1 == 2 %}no{% elif true %}yes{% else %}{{ x }}{% endif %}{{ 'c' | upper }}", ())
    assert t.tree == (chat.Text("ab2yesC"),)
    assert chat.Template("{% if x and false %}{{ y }}{% endif %}", ()).render(x=1)[0] == ""


@pytest.mark.parametrize("bad", ["{{ x.__class__ }}", "{{ f() }}", "{{ __import__ }}", "{% import x %}", "{% for x in y %}", "{{ x | eval }}",
                                 "{{ }}", "{{ 'a' 'b' }}", "{% set loop = 1 %}"])
def test_sandbox(bad):
    with pytest.raises(chat.TemplateError):
        chat.Template(bad).render(x="s", y=[1])


def test_mask():
    text, spans = chat.Template("q{% generation %}{{ a }}{% endgeneration %}z", ()).render(a="hey")
    assert text == "qheyz" and [text[a:b] for a, b in spans] == ["hey"]


def want(rows):
    turns = "".join(f"{r or ''}\n{t or ''}\n" for r, t in rows)
    loss = "".join(t or "" for r, t in rows if r == "assistant")
    return len(rows), hashlib.sha256(turns.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest()


def test_op10_round_trip(spark):
    from almanac.llm.queries import op10_chat
    by = defaultdict(list)
    for r in spark.read.parquet(f"{SF}/conversations.parquet").orderBy("conv_id", "turn").collect():
        by[r.conv_id].append((r.role, r.text))
    hard = "</s>[INST] ok [/INST]"
    by[-1] = [("user", hard), ("assistant", hard)]
    got = {r.conv_id: r for r in op10_chat(spark, SF).collect()}
    assert set(got) == set(by)
    for k, rows in by.items():
        r = got[k]
        assert (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) == want(rows)
        assert r.formatted_chars > sum(len(t or "") for _, t in rows)


def test_parts_nulls_ties_and_controls(spark):
    rows = [(1, t, "assistant" if t % 2 else "user", f"<|im_end|>\n<|im_start|>x {t}" * 5) for t in range(200)]
    rows += [(2, 0, None, None), (2, 1, "assistant", ""), (None, 0, "assistant", "é🙂"), (3, 0, "a", "x"), (3, 0, "a", "x"), (3, None, "b", "y"),
             (4, 0, "<|im_sep|>\n", "t")]
    df = spark.createDataFrame([(*r, "extra") for r in rows], "conv_id long, turn long, role string, text string, part string")
    formatted = chat.format_conversations(df, part_chars=300)
    assert max(r.part for r in formatted.collect()) > 20
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in chat.read_back(formatted).collect()}
    assert got[1] == want([(r[2], r[3]) for r in rows if r[0] == 1])
    assert got[2] == want([("", ""), ("assistant", "")])
    assert got[None] == want([("assistant", "é🙂")])
    assert got[3] == want([("b", "y"), ("a", "x"), ("a", "x")])
    assert got[4] == want([("<|im_sep|>\n", "t")])
    assert chat.read_back(chat.format_conversations(df.limit(0))).count() == 0
