"""Templates, escapes, and conversations read back from their formatted text."""

import hashlib
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stackweave.llm import chat
from tests.llm import helpers

SCHEMA = "conv_id long, turn long, role string, text string"
MESSAGES = [{"role": "user", "text": "a"}, {"role": "assistant", "text": "b"}, {"role": "user", "text": "c"}]


@pytest.mark.parametrize("source, want", [
    ("plain", "plain"),
    ("{{ 'a' ~ 1 + 2 }}{# gone #}!", "a3!"),
    ("{{ 7 % 4 - 1 * 2 }}", "1"),
    ("{{ x }}{{ x.y.z }}{{ who }}", "me"),
    ("{{ who | upper | lower ~ '!' }}", "me!"),
    ("{{ none | default('d') }}{{ messages | length }}", "d3"),
    ("{{ 'yes' if who == 'me' and not false else 'no' }}", "yes"),
    ("{{ 'b' in 'abc' }}{{ 'z' not in 'abc' }}{{ 2 >= 3 or 0 }}", "truetrue0"),
    ("{{ messages[0].text }}{{ messages[-1]['text'] }}{{ messages[9].text }}", "ac"),
    ("{% for m in messages %}{{ loop.index }}{{ m.text }}{% if not loop.last %},{% endif %}{% endfor %}", "1a,2b,3c"),
    ("{% set y = 'k' %}{% if who == 'x' %}1{% elif y == 'k' %}2{% else %}3{% endif %}", "2"),
    ("{% if true %}{% set y = 1 %}{{ y }}{% endif %}{{ y }}", "1"),
    (" {%- if who -%} \n t {{- '' }} {% endif %}", "t "),
    ("{% for m in messages %}{% for k in messages %}{{ loop.index0 }}{% endfor %}{{ loop.first }};{% endfor %}", "012true;012false;012false;"),
    (r"{{ 'it\'s\n' }}", "it's\n"),
    ("{{ 'a-b' | replace('-', '+') | trim }}", "a+b"),
])
def test_language(source, want):
    assert chat.Template(source).render(MESSAGES, who="me")[0] == want


@pytest.mark.parametrize("source", [
    "{{ }}", "{{ 1 + }}", "{% if x %}", "{% endif %}", "{% for x %}{% endfor %}", "{% nothing %}", "{{ x | system }}", "{{ x() }}",
    "{{ 'a' * 9 }}", "{% else %}", "{{ a b }}", "{{ x.__class__() }}", "{{ 'abc' < 1 }}", "{{ " + "(" * 60 + "1" + ")" * 60 + " }}",
    "{% generation %}{% generation %}{% endgeneration %}{% endgeneration %}", "{% if a %}{% else %}{% else %}{% endif %}", "{{ x ? }}",
])
def test_refused(source):
    with pytest.raises(chat.TemplateError):
        chat.Template(source).render([])


def test_nothing_of_python_can_be_reached():
    for source in ("{{ messages.__class__ }}", "{{ 'a'.__len__ }}", "{{ who.upper }}", "{{ messages['append'] }}"):
        assert chat.Template(source).render(MESSAGES, who="me")[0] == ""


def test_constants_are_folded():
    tree = chat.Template("a{{ 'b' ~ 2 * 3 }}{% if 1 == 2 %}x{% else %}c{% endif %}{{ '[INST]' | escape }}{{ x }}").tree
    assert tree == ("block", ("text", "ab6c[\\INST]"), ("write", ("name", "x")))
    tree = chat.Template("{% for m in messages %}{{ '<' ~ 's>' }}{% if false or m.a %}1{% endif %}{% endfor %}").tree
    assert tree == ("block", ("for", "m", ("name", "messages"), ("block", ("text", "<s>"), ("when", ("get", ("name", "m"), ("value", "a")), ("block", ("text", "1")), ("block",)))))


def test_spans_mark_generated_text():
    text, starts, ends = chat.Template("{% for m in messages %}<{{ m.role }}>{% if m.role == 'assistant' %}{% generation %}{{ m.text }}{% endgeneration %}{% endif %}{% endfor %}").render(MESSAGES)
    assert [text[a:b] for a, b in zip(starts, ends, strict=True)] == ["b"]


HARD = st.text(alphabet="[]/INST<>s|\\ end\n:é", max_size=40) | st.lists(st.sampled_from([*chat.CONTROLS, "\\", "<", "[", "|", "x", " [/INST]", "<|end|>"]), max_size=8).map("".join)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system"]) | HARD, HARD), max_size=6))
def test_round_trip(turns):
    escape = chat.escaper()
    for _, text in turns:
        assert chat.unescaped(escape(text)) == text and not any(c in escape(text) for c in chat.CONTROLS)
    messages = [{"role": role, "text": text} for role, text in turns]
    for size in (1, 20, chat.PIECE):
        pieces = list(chat.Template().pieces(iter(messages), size))
        assert [t for text, _, _ in pieces for t in chat.turns_of(text)] == turns
        loss = [chat.unescaped(text[a:b]) for text, starts, ends in pieces for a, b in zip(starts, ends, strict=True)]
        assert loss == [text for role, text in turns if role == "assistant"]


def by_hand(rows):
    rows = sorted(((t, r or "", x or "") for t, r, x in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    loss = "".join(x for _, r, x in rows if r == "assistant")
    whole = "".join(f"{r}\n{x}\n" for _, r, x in rows)
    return len(rows), hashlib.sha256(whole.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest()


def test_rows_of_all_kinds(spark):
    dice = random.Random(5)
    pick = lambda: (dice.choice([None, 0, 1, 2, 2]), dice.choice(["user", "assistant", "system", None, "", "a|>b"]), dice.choice(["hi", "", None, "</s>[INST] x", "\\<|", "é" * 9]))
    convs = {k: [pick() for _ in range(dice.randrange(1, 7))] for k in range(40)}
    convs[None] = convs[1]
    convs[77] = [(t, ("user", "assistant")[t % 2], f"text {t} " * 50) for t in range(4000)]
    df = spark.createDataFrame([(k, *row) for k, rows in convs.items() for row in rows], SCHEMA).withColumn("piece", F.lit("mine"))
    names = ("n_turns", "turns_sha256", "loss_chars", "loss_sha256")
    pieces = chat.formatted(df.repartition(4), size=5000)
    for back in (chat.read_back(pieces, in_place=True), chat.read_back(pieces.repartition(3))):
        assert {r.conv_id: tuple(r[n] for n in names) for r in back.collect()} == {k: by_hand(rows) for k, rows in convs.items()}
    assert pieces.where("conv_id = 77").count() > 100
    assert chat.read_back(chat.formatted(df.limit(0))).count() == 0


def test_other_templates_run_in_spark(spark):
    df = helpers.awkward(spark).select(F.col("doc_id").alias("conv_id"), F.lit(0).alias("turn"), F.lit("x").alias("role"), "text")
    lines = chat.formatted(df, "{% for m in messages %}{{ m.role | upper }}{{ m.text | length }};{% endfor %}{{ messages[0].text }}")
    assert {r.conv_id: r.text for r in lines.collect()}[3] == "X0;"
