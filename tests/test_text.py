"""Predicates and scalars on hand-made edge cases."""

import random

import pytest
from pyspark.sql import functions as F

from catalogops.functions import replies, text


def values(spark, texts, column):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r.v for r in df.select("i", column.alias("v")).orderBy("i").collect()]


def test_strip_takes_every_whitespace(spark):
    texts = ["\t a \n", " a　", "   ", "\x1c\x85a b ", None, "a"]
    got = values(spark, texts, text.strip_ws("t"))
    assert got == [None if t is None else t.strip() for t in texts]


def test_word_prefix(spark):
    texts = ["Dealership Hub", "Fine Reagents", "Kit (OEM)", "Top Dealers", "my\tdealer", None]
    got = values(spark, texts, text.word_prefix("t", ["dealer", "agent", "oem"]))
    assert got == [True, False, False, True, False, None]


def test_substring_has_no_boundary(spark):
    got = values(spark, ["Steam Valve", "Iced Tea", "valve"], text.any_substring("t", ["tea"]))
    assert got == [True, True, False]


def test_padded_or_suffix(spark):
    texts = ["crm", "My CRM Kit", "xcrm", "crmx", "crm lift", " CRM \n", "a\ncrm b"]
    got = values(spark, texts, text.padded_or_suffix("t", ["crm"], ["lift"]))
    assert got == [True, True, True, False, False, True, False]


def test_keywords_are_literal(spark):
    got = values(spark, ["a.b", "axb", r"q\Ez"], text.any_substring("t", ["a.b", r"q\ez"]))
    assert got == [True, False, True]
    with pytest.raises(ValueError):
        text.any_substring("t", [])


def reference_prefix(s, words):
    return any(f" {w}" in f" {s.lower()}" for w in words)


def reference_padded(s, words, veto):
    low = s.lower().strip()
    if any(v in low for v in veto):
        return False
    return any(f" {w} " in f" {low} " or low.endswith(w) for w in words)


def test_predicates_on_random_strings(spark):
    rng = random.Random(5)
    parts = ["erp", "crm", "saas", "lift", " ", "  ", "\t", "\n", "x", "(", ")", "CRM", " "]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 7))) for _ in range(600)]
    words, veto = ["erp", "crm"], ["lift"]
    assert values(spark, texts, text.word_prefix("t", words)) == [
        reference_prefix(s, words) for s in texts
    ]
    assert values(spark, texts, text.padded_or_suffix("t", words, veto)) == [
        reference_padded(s, words, veto) for s in texts
    ]


def test_numbered(spark):
    assert values(spark, ["a"], text.numbered("cluster", F.lit(7))) == ["cluster_0007"]
    assert values(spark, ["a"], text.numbered("cluster", F.lit(12345))) == ["cluster_12345"]


def test_clean_reply(spark):
    texts = [
        'Here:\n```json\n[{"k": 1},\n {"k": 2}]\n```\nbye', '{"k": 1}', "sorry", "",
        '{"k": 1} trailing', "```\n[1]\n```", 'a {"b": [1, 2]} c', None,
    ]
    got = values(spark, texts, replies.clean_reply("t"))
    assert got == [
        '[{"k": 1},\n {"k": 2}]', '{"k": 1}', "sorry", "", '{"k": 1}', "[1]", '{"b": [1, 2]}', None
    ]
