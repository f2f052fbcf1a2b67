from __future__ import annotations

import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from strata.llm import chat as C
from strata.llm import queries as Q
from strata.llm.common import table
from tests.llm.conftest import SF001

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def expected(rows):
    convs = {}
    for conv, turn, role, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        convs.setdefault(conv, []).append((role or "", text or ""))
    out = {}
    for conv, turns in convs.items():
        loss = "".join(t for r, t in turns if r == "assistant")
        out[conv] = (len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def test_query_on_the_small_tables(spark):
    rows = [tuple(r) for r in table(spark, SF001, "conversations").select("conv_id", "turn", "role", "text").collect()]
    said = "</s>[INST] ok [/INST]"
    rows += [(-1, 0, "user", said), (-1, 1, "assistant", said)]
    got = Q.op9_chat(spark, SF001).collect()
    assert {r["conv_id"]: tuple(r)[1:5] for r in got} == expected(rows)
    assert all(r["formatted_chars"] > r["loss_chars"] for r in got)


def test_defined_cases(spark, docs_of, monkeypatch):
    odd = ["", None, "\\", "\\<s>", "<s></s>", "[/INST][INST]", "[TURN]a\nb[/TURN]", "{{ x }}{% if %}", "😀[SYS]", "a\\</s", "x" * 300000]
    rows = [(1, i, r, t) for i, t in enumerate(odd) for r in ("user", "assistant", "system", "tool", "to\nol[/TURN]\\", None)]
    rows += [(None, 1, "user", "a"), (None, None, "assistant", "b"), (2, 1, "assistant", "only"), (2, 1, "assistant", "only"), (3, 5, "user", "z"), (3, 5, "assistant", "a"), (4, 0, "user", None)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' as part", "'y' as spans", "'z' as formatted")
    got = C.read_back(C.format_conversations(df)).collect()
    assert {r["conv_id"]: tuple(r)[1:5] for r in got} == expected(rows)
    formatted = C.format_conversations(df).where("conv_id = 1")
    assert formatted.count() > 1  # long conversations come in parts
    assert C.read_back(C.format_conversations(spark.createDataFrame([], SCHEMA))).collect() == []


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "a\\\nb", ""]), st.text(st.sampled_from("\\<>/s[]INSTURYx\n"), max_size=30) | st.sampled_from(["</s>", "[INST]", "\\</s>"])), max_size=6))
def test_any_text_comes_back(turns):
    render = C.compile_template()
    pieces = list(render({"role": r, "text": t} for r, t in turns))
    assert list(C.read_turns(["".join(p for p, m in pieces if m is not None)])) == turns
    assert [C.unescape(p) for p, m in pieces if m] == [t for r, t in turns if r == "assistant"]


def test_language():
    def out(template, **names):
        return "".join(p for p, m in C.compile_template(template)(names.pop("messages", []), **names) if m is not None)

    assert out("a{{ 'b' + 1 }}{{ x | upper }}", x="c") == "ab1C"
    assert out("{% for m in messages %}{% if loop.first %}<{% elif loop.last %}>{% else %}{{ loop.index0 }}{% endif %}{{ m['t'] }}{% endfor %}", messages=iter([{"t": "a"}, {"t": "b"}, {"t": "c"}])) == "<a1b>c"
    assert out("{% if not x and (y == 'q' or z != 2) %}yes{% else %}no{% endif %}", y="q") == "yes"
    assert out("{{ x.y.z }}{{ missing }}", x={"y": {"z": "deep"}}) == "deep"


def test_constants_are_folded():
    assert C.fold(C.parse("a{{ 'b' + 'c' | upper }}{% if 1 == 2 %}x{% else %}d{% endif %}{{ 'e' }}")) == [("text", "abCde")]
    assert C.fold(C.parse("{% if true_name %}x{% elif 1 == 1 %}y{% else %}z{% endif %}"))[0][2] == [("text", "y")]


@pytest.mark.parametrize("bad", ["{{ x.__class__() }}", "{{ open('f') }}", "{% for x %}{% endfor %}", "{% if a %}", "{{ a | run }}", "{{ a b }}", "{% import os %}", "{% endfor %}", "{{ }}"])
def test_sandbox_refuses(bad):
    with pytest.raises(C.TemplateError):
        C.compile_template(bad)


def test_attributes_are_only_items():
    assert "".join(p for p, _ in C.compile_template("{{ x.__class__ }}")([], x="s")) == ""
