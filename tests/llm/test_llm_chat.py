import hashlib
import random

import pytest

from tallyshelf.llm.chat import (
    CONTROLS,
    FILTERS,
    TEMPLATE,
    format_conversations,
    line,
    read_back,
    safe,
    unline,
    unsafe,
)
from tallyshelf.llm.templates import Const, Print, Template, TemplateError, Text, generated_spans, parse

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def brute(turns):
    turns = [(r or "", t or "") for _, r, t in sorted(turns, key=lambda x: (x[0] is not None, x[0] or 0, x[1] or "", x[2] or ""))]
    digest = hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
    loss = "".join(t for r, t in turns if r == "assistant")
    return len(turns), digest, len(loss), hashlib.sha256(loss.encode()).hexdigest()


def read(spark, rows, **more):
    formatted = format_conversations(spark.createDataFrame(rows, SCHEMA), "conv_id", "turn", "role", "text", **more)
    return {r.conversation: tuple(r)[1:5] for r in read_back(formatted).collect()}


def odd_text(rng):
    pieces = [*CONTROLS, "<", "|", ">", "\\", "\n", "end|>", "<|end|>\n", "INST]", "é🙂", "a ", "</", "[", "/"]
    return "".join(rng.choices(pieces, k=rng.randint(0, 12)))


def test_escapes_are_reversible_and_leave_no_control_string():
    rng = random.Random(1)
    for _ in range(5000):
        text = odd_text(rng)
        assert unsafe(safe(text)) == text
        assert not any(c in safe(text) for c in CONTROLS)
        assert unline(line(text)) == text
        assert "|" not in line(text)


def test_conversations_read_back_as_they_were(spark):
    rng = random.Random(2)
    roles = ["user", "assistant", "system", None, "", "tool|>", "<|end|>\n", "a\\p|"]
    rows = [
        (c, rng.choice([None, *range(9)]), rng.choice(roles), rng.choice([None, odd_text(rng)]))
        for c in [None, *range(40)]
        for _ in range(rng.randint(1, 9))
    ]
    rows += [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]
    rows += rows[:3]
    by = {}
    for c, *turn in rows:
        by.setdefault(c, []).append(turn)
    assert read(spark, rows) == {c: brute(t) for c, t in by.items()}


def test_long_conversations_cross_batches(spark):
    rows = [(1, i, ["user", "assistant"][i % 2], f"text {i} " * (i % 50)) for i in range(5000)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 300)
    try:
        assert read(spark, rows) == {1: brute([r[1:] for r in rows])}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_empty_table(spark):
    assert read(spark, []) == {}


def test_the_default_format():
    messages = [{"role": "user", "text": "hi"}, {"role": "assistant", "text": "<|end|> yes"}]
    text, spans = generated_spans(Template(TEMPLATE, FILTERS).render(messages=messages))
    assert text == "<|user|>\nhi<|end|>\n<|assistant|>\n<\\|end|> yes<|end|>\n"
    assert [text[a:b] for a, b in spans] == ["<\\|end|> yes"]


@pytest.mark.parametrize(
    "source, expected",
    [
        ("plain", "plain"),
        ("{{ 1 + 2 }}{{ 'a' ~ 1 }}{{ \"x\\n\" }}", "3a1x\n"),
        ("{% if a %}A{% elif b == 'B' %}B{% else %}C{% endif %}", "B"),
        ("{{ 'yes' if a or not b else 'no' }}", "no"),
        ("{% for x in xs %}{{ loop.index }}{{ x }}{% if not loop.last %},{% endif %}{% endfor %}", "1p,2q"),
        ("{% for x in xs %}{% if loop.first %}^{% endif %}{{ loop.previous }}{% endfor %}", "^p"),
        ("{% set y = b ~ '!' %}{{ y }}{{ nothing }}{{ m.k }}{{ m['k'][0] }}{{ 'k' in m }}", "B!vvTrue"),
        ("{# a comment #}{{ b | loud }}", "B!"),
        ("{{ (1 < 2) and 3 >= 3 }}", "True"),
    ],
)
def test_templates(source, expected):
    variables = {"a": False, "b": "B", "xs": ["p", "q"], "m": {"k": "v"}}
    assert Template(source, {"loud": lambda t: t + "!"}).text(**variables) == expected


@pytest.mark.parametrize(
    "source",
    [
        "{{ a.__class__ }}",
        "{{ _x }}",
        "{{ a() }}",
        "{{ a | nofilter }}",
        "{% for x in y %}",
        "{% endif %}",
        "{% import os %}",
        "{{ 1 + }}",
        "{{ a b }}",
        "{{ a; b }}",
    ],
)
def test_the_sandbox_and_faults(source):
    with pytest.raises(TemplateError):
        Template(source)


def test_attributes_are_not_reached():
    assert Template("{{ a.upper }}{{ a['format'] }}").text(a="x") == ""


def test_constants_are_folded():
    assert parse("{{ 'a' }}") == (Print(Const("a")),)
    assert Template("x{{ 'a' ~ 1 }}{% if 1 == 1 %}y{% else %}{{ z }}{% endif %}").tree == (Text("xa1y"),)
    assert Template("{% if true and u %}y{% endif %}").tree[0].test.name == "u"


def test_loops_are_lazy():
    def endless():
        i = 0
        while True:
            yield {"text": str(i)}
            i += 1

    fragments = Template("{% for m in messages %}{{ m.text }};{% endfor %}").render(messages=endless())
    assert "".join(next(fragments)[0] for _ in range(6)) == "0;1;2;"


def test_minus_marks_take_white_space_away():
    assert Template("a  {%- if x -%}  b  {%- endif -%}  c {{- 1 -}}\n d").text(x=True) == "abc1d"
    assert Template("a  {%- if x -%}  b  {%- endif %}  c").text(x=False) == "a  c"
    assert Template("a {# gone #} b {#- gone #}").text() == "a  b "


def test_a_block_ends_outside_its_strings():
    assert Template("{{ '}}' }}{{ \"%}\" ~ '{{' }}{% if '%}' == x %}y{% endif %}").text(x="%}") == "}}%}{{y"
    assert Template(r"{{ 'it\'s }}' }}").text() == "it's }}"


@pytest.mark.parametrize(
    "source",
    ["{% if a %}x{% else %}y{% else %}z{% endif %}", "{% if a %}x{% else %}y{% elif b %}z{% endif %}", "{{ a", "{% if a", "{# a", "{{ 'a }}"],
)
def test_faults_that_would_lose_text_are_refused(source):
    with pytest.raises(TemplateError):
        Template(source)


@pytest.mark.parametrize("source", ["{{ 1 + 'a' }}", "{{ x < 3 }}", "{{ 3 in 4 }}", "{{ x + 'b' }}"])
def test_operations_without_meaning_are_template_errors(source):
    with pytest.raises(TemplateError):
        Template(source).text()


def test_other_columns_may_have_any_name(spark):
    rows = [(1, 0, "user", "a"), (1, 1, "assistant", "b"), (2, 0, "user", None)]
    schema = SCHEMA + ", conversation int, role_text int, piece int, fragments int"
    df = spark.createDataFrame([(*r, 1, 2, 3, 4) for r in rows], schema)
    formatted = format_conversations(df, "conv_id", "turn", "role", "text")
    assert {r.conversation: tuple(r)[1:5] for r in read_back(formatted).collect()} == read(spark, rows)
