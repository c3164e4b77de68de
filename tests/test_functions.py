"""Text functions and rules on rows whose results are known."""

import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.functions import lexicons as lex
from millrace.functions import logs, rules
from millrace.functions import text as tx


def apply(spark, function, values, kind="string"):
    df = spark.createDataFrame(list(enumerate(values)), f"i int, x {kind}")
    return [r.y for r in df.select("i", function(F.col("x")).alias("y")).orderBy("i").collect()]


UNITS = {
    "2 kg ha 1": "2 kg/ha",
    "2 kg/ha 1": "2 kg/ha",
    "2 kg ha-1": "2 kg/ha",
    "2 kg ha": "2 kg/ha",
    "50 g m 2": "50 g/m²",
    "5 km h 1": "5 km/h",
    "2-4 L m 1 h 1": "2-4 L/m/h",
    "10^9 CFU L 1": "10^9 CFU/L",
    "1-109 cfu": "10^9 cfu",
    "1109 CFU": "10^9 CFU",
    "price 1109": "price 1109",
    "Ficusspp.": "Ficus spp.",
    "Ficus spp.": "Ficus spp.",
    "2.5 m x 2.5 m": "2.5 m x 2.5 m",
    "dig to m 2.5": "dig to m 2.5",
    "3 m 2": "3 m²",
    "5-000": "5000",
    "two kg ha": "two kg/ha",
    "t\u00a0HA": "t/ha",
    "some kg K2O ha": "some kg K2O/ha",
    "thing ha": "thing ha",
    "ml\nhalf": "ml\nhalf",
    "": "",
}


def test_units(spark):
    assert apply(spark, tx.normalize_units, list(UNITS)) == list(UNITS.values())


def test_units_twice_is_once(spark):
    once = apply(spark, tx.normalize_units, list(UNITS))
    assert apply(spark, tx.normalize_units, once) == once


def test_numbers(spark):
    given_ = ["1,000", "2,5", "2.50", "04", "0", "0.0", "1,234,567 and 12,34", "no", None]
    found = apply(spark, lambda x: F.array_sort(tx.extract_numbers(x)), given_)
    assert found == [["1000"], ["2.5"], ["2.5"], ["4"], ["0"], ["0"], ["12.34", "1234567"], [], []]


def test_word_count_and_clip(spark):
    assert apply(spark, tx.word_count, ["", "  ", "a", " a b c\n", None]) == [0, 0, 1, 3, 0]
    assert [len(x) for x in apply(spark, tx.clip, ["x" * 160, "x" * 161])] == [160, 160]


@settings(max_examples=30, deadline=None)
@given(st.lists(st.text(alphabet=" \t\n\x1c\x1f  abé", max_size=12), min_size=1, max_size=40))
def test_strip_is_unicode_strip(spark, values):
    assert apply(spark, tx.strip, values) == [v.strip() for v in values]
    assert apply(spark, tx.word_count, values) == [len(v.split()) for v in values]


def test_row_key_classes(spark):
    keys = apply(spark, lambda x: tx.row_key(x, F.lit("r")), ["A  b", " a b ", "a c", None, ""])
    assert keys[0] == keys[1] != keys[2] and keys[3] == keys[4]


def test_whole_words_are_unicode(spark):
    assert apply(spark, lambda x: rules.word_hits(x, ("active",)), ["éactive", "Active.", "inactive", "active"]) == [[], ["active"], [], ["active"]]


def test_first_reason_order(spark):
    df = spark.createDataFrame([("", "x", "", ""), ("a", "a", "", ""), ("q", "mtandaoni mulch", "", ""), ("q", "the mulch", "", ""), ("q", "Premix: x", "", ""), ("q", "use 4 g", "5 kg", ""), ("q", "fine", "fine", "fine"), ("q", "x" * 300, "", "fine")], "u string, a string, su string, sa string")
    reason = rules.first_reason(*[F.col(c) for c in ("u", "a", "su", "sa")])
    found = [r.r for r in df.select(reason.alias("r")).collect()]
    assert found[-1] == "assistant translation too long: 300 chars > 263 chars"
    assert [x and x.split(":")[0] for x in found] == ["empty translated user turn", "user and assistant translations are identical", "QC forbidden Swahili phrases", "QC untranslated English terms", "QC English headings", "missing numerals from English", None, "assistant translation too long"]


def test_language_tie_passes_both(spark):
    for expected in ("sw", "en"):
        assert apply(spark, lambda x: rules.language_match(F.lit(expected), x), ["zzz"]) == [True]
        assert apply(spark, lambda x: rules.language_match(F.lit(expected), x, tie="strict"), ["zzz"]) == [False]


def test_rubric_of_empty_output(spark):
    flags = lambda x: F.struct(*[c.alias(n) for n, c in rules.rubric(F.lit("crops"), F.lit("en"), x).items()])
    row = apply(spark, flags, [""])[0]
    assert row.empty and row.score == 0.5


def test_embedded_json(spark):
    raw = ['{"user": "q"}', '```json\n{"user": "q"}\n```', 'so: {"user": "q"} ok', "nothing", None]
    assert [x and x.user for x in apply(spark, lambda x: tx.embedded_json(x, "user string"), raw)] == ["q", "q", "q", None, None]


def test_logs(spark):
    log = "Mean KLD: 0.0123 ± 0.0004\nSame top p: 95.1 ± 0.2 %\nFinal estimate: PPL = 7.5 +/- 0.1\n| a | 12.5 ± 0.1 |\n| b | 30 |\n123\n"
    value, error = logs.kld_and_error(F.col("x"))
    one = spark.createDataFrame([(log,), ("",)], "x string").select(value, error, logs.same_top(F.col("x")), logs.perplexity(F.col("x")), logs.rates(F.col("x")), logs.peak_memory(F.col("x"))).collect()
    assert tuple(one[0]) == (0.0123, 0.0004, 95.1, 7.5, [12.5, 30.0], 123.0)
    assert tuple(one[1]) == (None, None, None, None, [], None)


@pytest.mark.parametrize("name,expected", [("blk.3.attn_q.weight", "attn_q"), ("blk.3.weight", None), ("output.weight", None)])
def test_weight_family(spark, name, expected):
    assert apply(spark, tx.weight_family, [name]) == [expected]


def test_lists_are_distinct():
    from millrace.functions import lexicons as lex

    for words in (lex.BAD_PHRASES, lex.ENGLISH_TERMS, lex.ENGLISH_HEADINGS):
        assert len(set(words)) == len(words)
    assert all(re.compile(p) for p, _ in lex.BAD_PATTERNS)


def test_words_in_any_case(spark):
    """The plain search before a pattern loses nothing that the pattern finds without case."""
    texts = ["S\u0130LO", "ma\u017fk", "MA\u017fK up", "wee\u212as", "s\u0131lo", "SILOS", "xmask", "mask_", "mask\u0301", "stra\u00dfe tray", None, ""]
    found = apply(spark, lambda x: rules.word_hits(x), texts)
    plain = apply(spark, lambda x: F.array_sort(F.array_compact(F.array(*[F.when(x.rlike(rf"(?iU)(?<!\w)(?:{rules.quoted(w)})(?!\w)"), F.lit(w)) for w in lex.ENGLISH_TERMS]))), texts)
    assert found == plain and ["tray"] in found and ["weeks"] in found
    assert apply(spark, rules.phrase_hits, [None, "MTANDAONI"]) == [[], ["mtandaoni"]]
