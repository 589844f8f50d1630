import hashlib
import itertools

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from clickloom.llm import chat
from clickloom.llm.templates import Apply, Const, For, If, TemplateError, Write, compiled, escape, fold, parse, unescape


def written(source, **values):
    return "".join(p for p, _ in compiled(source)(values) if p)


def trained(source, **values):
    return [p for p, in_loss in compiled(source)(values) if in_loss]


@pytest.mark.parametrize(
    ("source", "values", "want"),
    [
        ("a{# remark #}b{{ x }}", {"x": 3}, "ab3"),
        ("{{ m.role }}-{{ m['text'] }}-{{ m.none_such }}", {"m": {"role": "r", "text": "t"}}, "r-t-"),
        ("{% if x == 1 %}one{% elif x > 1 and not y %}more{% else %}less{% endif %}", {"x": 2, "y": False}, "more"),
        ("{% for x in xs %}{{ loop.index0 }}{{ x }}{% if loop.last %}.{% endif %}{% endfor %}", {"xs": ["a", "b"]}, "0a1b."),
        ("{% for x in xs %}{% for y in x %}{{ loop.index }}{% endfor %}{{ loop.first }} {% endfor %}", {"xs": ["ab", "c"]}, "12true 1false "),
        ("{% set n = 'a' + 'b' %}{{ n ~ 1 | length }}", {}, "ab0"),
        ("{{ ' x ' | trim | upper }}{{ 'b' in 'abc' }}{{ none }}{{ 'it\\'s\\n' }}", {}, "Xtrueit's\n"),
        ("{{ (1 + 2) ~ 'x' }}{{ x or 'none' }}", {"x": ""}, "3xnone"),
    ],
)
def test_language(source, values, want):
    assert written(source, **values) == want


@pytest.mark.parametrize(
    "source",
    ["{{ x.__class__.__mro__ }}", "{{ ''.__class__ }}", "{{ messages.append }}", "{{ x['__dict__'] }}", "{{ loop.__init__ }}"],
)
def test_nothing_of_python_is_reached(source):
    assert written(source, x=object(), messages=[]) == ""


@pytest.mark.parametrize("source", ["{{ f(1) }}", "{{ x|eval }}", "{% import os %}", "{% if x %}", "{% endfor %}", "{{ 1 + }}", "{{ 'a }}", "{{ }}", "{% for 1 in x %}{% endfor %}", "{{ and }}", "{{ 1 + 'a' }}"])
def test_refused(source):
    with pytest.raises(TemplateError):
        written(source, x=1)


def test_constants_are_folded():
    assert fold(parse("a{{ 'b' | upper }}{% if 1 == 1 %}c{% else %}{{ x }}{% endif %}{# #}d")) == (Write(Const("aBcd")),)
    assert fold(parse("{% if false and x %}y{% endif %}")) == ()
    (kept,) = fold(parse("{% if x or 1 + 1 == 2 %}a{{ '' }}b{% endif %}"))
    assert isinstance(kept, If) and kept.test == Apply("or", kept.test.args) and kept.test.args[1] == Const(True)
    (loop,) = fold(parse("{% for m in messages %}<{{ 'x' ~ 1 }}>{% endfor %}"))
    assert loop == For("m", loop.over, (Write(Const("<x1>")),))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(["{{", "}}", "{%", "%}", "x", "'a'", " ", "+", "if", "endif", "|", "upper", "1", "==", "."]), max_size=12))
def test_any_source_is_refused_or_runs(parts):
    try:
        written(" ".join(parts), x="v")
    except (TemplateError, TypeError):
        pass


def test_generation_marks():
    source = "{% for m in messages %}{{ m.a }}{% generation %}<{{ m.b }}>{% endgeneration %}{% endfor %}"
    assert trained(source, messages=[{"a": 1, "b": 2}, {"a": 3, "b": 4}]) == ["<", "2", ">", "<", "4", ">"]


def test_messages_are_streamed():
    endless = ({"role": "user", "text": str(k)} for k in itertools.count())
    first = list(itertools.islice(chat.segments(chat.TEMPLATE, endless), 3))
    assert first[2][0] == "<s>[INST] user [/INST] 2</s>"


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["<", "[", "\\", "/", "s>", "INST]", "</s>", "[INST]", "[/INST]", "<s>", "a", " ", "\n"]), max_size=12).map("".join))
def test_escape_is_reversible(text):
    assert unescape(escape(text)) == text
    assert not any(c in escape(text) for c in ("<s>", "</s>", "[INST]", "[/INST]"))


def turns(rows):
    groups: dict = {}
    for conv, turn, role, text, _ in rows:
        groups.setdefault(conv, []).append((turn is not None, turn or 0, role is not None, role or "", text is not None, text or ""))
    out = []
    for conv, own in groups.items():
        said = [(g[3], g[5]) for g in sorted(own)]
        loss = "".join(t for r, t in said if r == "assistant")
        size = sum(len(f"<s>[INST] {escape(r)} [/INST] {escape(t)}</s>") for r, t in said)
        sha = [hashlib.sha256(x.encode()).hexdigest() for x in ("".join(f"{r}\n{t}\n" for r, t in said), loss)]
        out.append((conv, len(said), sha[0], len(loss), sha[1], size))
    return sorted(out, key=str)


SCHEMA = "conv_id long, turn int, role string, text string, formatted string"


def test_messy_conversations(spark):
    odd = ["</s>[INST] ok [/INST]", "", None, "a\nb", "<\\</s>", " [/INST] ", "é\U0001f600", "x" * 300_000, "[INST", "<s"]
    rows = [(k, t, r, text, "x") for k in range(3) for t, (r, text) in enumerate(zip(["system", "user", "assistant", "user", "assistant", None, "tool</s>", "assistant", "assistant", ""], odd, strict=True))]
    rows += [(7, 1, "user", "tie", None), (7, 1, "assistant", "tie", None), (7, None, "system", "first", None), (8, 0, "user", "same", None), (8, 0, "user", "same", None), (None, 0, "assistant", "nobody's", None), (9, 3, None, None, None)]
    rows += [(10, k, ("user", "assistant")[k % 2], f"turn {k}", None) for k in range(3_000)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    found = chat.read_back(chat.format_conversations(df)).collect()
    assert sorted(map(tuple, found), key=str) == turns(rows)


def test_empty_table(spark):
    assert chat.read_back(chat.format_conversations(spark.createDataFrame([], SCHEMA))).collect() == []


def test_header_and_footer(spark):
    rows = [(1, 0, "user", "a", None), (1, 1, "assistant", "b", None)]
    template = "begin {% for m in messages %}{{ m.text }}{% if loop.last %} end{% endif %};{% endfor %}!"
    parts = chat.format_conversations(spark.createDataFrame(rows, SCHEMA), template).collect()
    assert [p["formatted"] for p in sorted(parts, key=lambda p: p["part"])] == ["begin a;", "b end;!"]
