from __future__ import annotations

import html
import random
import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from textloom.functions import profile, text
from textloom.operators import prepare

# Expected values come from the standard library.
TYPOGRAPHY = {"“": '"', "”": '"', "‘": "'", "’": "'", "`": "'", "«": '"', "»": '"', "–": "-", "—": "-", "―": "-", "−": "-"}
TYPOGRAPHY |= {"﻿": "", "​": "", "‎": "", "‏": "", "\xa0": " "}


def expected(raw: str | None, lowercase: bool = True) -> str:
    if raw is None:
        return ""
    out = unicodedata.normalize("NFC", html.unescape(raw)).translate(str.maketrans(TYPOGRAPHY))
    out = out.lower() if lowercase else out
    return re.sub("[ \t\r\n]+", " ", out).strip()


INLINE = [
    None, "", "   \t\n ", "!!!", "​", "​ ‎", "a‌b‍c", "﻿शीर्षक",
    "Tom &amp; Jerry &quot;x&quot; &#39;y&#39; &#2325; &nbsp;z&nbsp; &ampx &notit; &bogus; &#0; &#x110000; &#128;",
    "&#8203;&#8203;", "“a” ‘b’ `c` «d» e–f—g―h−i", "café Å Å Ω", "क़ ड़ क़ ज़ ढ़ ऩ",
    "İstanbul ΣΑΣ ẞ", "a\tb\r\nc  d   e", " lead and trail\x1c", "\x1cin\x0cner\x0b\x85", "a 　 b", "  x ", "नवीन 5G स्मार्टफोन",
    "q̣̇", "q̣̇", "क़्", "가", "𝐀 😀 x", "à́b", "AT&T &lt;b&gt;", " x ",
]


def random_texts(n: int = 400) -> list[str]:
    rng = random.Random(7)
    blocks = [(0x20, 0x7E), (0xA0, 0x2FF), (0x300, 0x36F), (0x900, 0x97F), (0x1E00, 0x1EFF), (0x2000, 0x206F), (0x3000, 0x30FF), (0xAC00, 0xAC50), (0x1100, 0x11FF), (0xF900, 0xFA20), (0x9, 0xD)]
    return ["".join(chr(rng.randint(*rng.choice(blocks))) for _ in range(rng.randint(1, 12))) for _ in range(n)]


@pytest.mark.parametrize("lowercase", [True, False])
def test_cleaning_matches_the_standard_library(spark, lowercase):
    raw = INLINE + random_texts()
    df = spark.createDataFrame(list(enumerate(raw)), "i int, t string")
    got = {r.i: r.c for r in df.select("i", text.clean_text(F.col("t"), lowercase).alias("c")).collect()}
    wrong = [(raw[i], got[i], expected(raw[i], lowercase)) for i in got if got[i] != expected(raw[i], lowercase)]
    assert not wrong, wrong[:5]


def test_characters_that_skip_the_unicode_pass_are_stable():
    """All characters outside the guard are in NFC, combine with nothing and are not standardised."""
    guard = re.compile(text._SPECIAL.replace("\\x{10FFFF}", "\\U0010FFFF"))
    second_in_pair = set()
    for c in map(chr, range(0x110000)):
        parts = unicodedata.decomposition(c).split()
        if len(parts) == 2 and not parts[0].startswith("<"):
            second_in_pair.add(chr(int(parts[1], 16)))
    classes = set()
    for c in map(chr, range(0x110000)):
        if guard.match(c):
            continue
        assert unicodedata.normalize("NFC", c) == c
        assert c not in second_in_pair and c not in TYPOGRAPHY and c != "&"
        classes.add(unicodedata.combining(c))
    # A single non-zero class cannot be out of order with itself.
    assert classes <= {0, 9}


def test_html_unescape_alone(spark):
    raw = [t for t in INLINE if t]
    df = spark.createDataFrame(list(enumerate(raw)), "i int, t string").select("i", text.unescape_html(F.col("t")).alias("u"))
    assert {r.i: r.u for r in df.collect()} == {i: html.unescape(t) for i, t in enumerate(raw)}


def test_tokens_keep_devanagari_words_whole(spark):
    raw = ["भारताने अंतिम सामन्यात विजय मिळवला", "5g-स्मार्टफोन, १० हजार_x!", "!!!", "", "a"]
    df = spark.createDataFrame(list(enumerate(raw)), "i int, t string").select("i", text.tokens(F.col("t")).alias("w"))
    got = {r.i: r.w for r in df.collect()}
    assert got[0] == raw[0].split() and len(got[0]) == 5
    assert got[1] == ["5g", "स्मार्टफोन", "१०", "हजार_x"]
    assert got[2] == [] and got[3] == [] and got[4] == ["a"]


@pytest.mark.parametrize("low,high", [(1, 1), (1, 2), (2, 3), (3, 3)])
def test_ngrams_and_counts(spark, low, high):
    docs = [[], ["a"], ["a", "b"], ["a", "b", "a", "b", "a"], ["x", "x", "x", "x"]]
    df = spark.createDataFrame(list(enumerate(docs)), "i int, w array<string>")
    got = {r.i: r for r in df.select("i", text.ngrams(F.col("w"), low, high).alias("g"), text.term_counts(text.ngrams(F.col("w"), low, high)).alias("c")).collect()}
    for i, w in enumerate(docs):
        grams = [" ".join(w[k : k + n]) for n in range(low, high + 1) for k in range(len(w) - n + 1)]
        assert sorted(got[i].g) == sorted(grams)
        assert {e.term: e.tf for e in got[i].c} == {g: grams.count(g) for g in grams}


def test_ngram_range_is_checked():
    with pytest.raises(ValueError):
        text.ngrams(None, 2, 1)


def test_word_count_is_python_split(spark):
    raw = [t for t in INLINE if t is not None] + random_texts(200)
    df = spark.createDataFrame(list(enumerate(raw)), "i int, t string").select("i", profile.word_count(F.col("t")).alias("n"))
    assert {r.i: r.n for r in df.collect()} == {i: len(t.split()) for i, t in enumerate(raw)}


def test_profile(spark):
    raw = ["भारत India 2024 १२", "", "   ", "😀 a", "abक", "123"]
    df = prepare.with_profile(spark.createDataFrame(list(enumerate(raw)), "i int, t string"), F.col("t"))
    got = {r.i: (r.words, r.chars, r.devanagari_pct, r.latin_pct, r.digits) for r in df.collect()}
    assert got[0] == (4, 18, 55, 45, 6)  # 6 Devanagari signs (digits included) of 11, 5 Latin
    assert got[1] == (0, 0, 0, 0, 0) and got[2] == (0, 3, 0, 0, 0)
    assert got[3] == (2, 4, 0, 100, 0) and got[4][2:4] == (33, 67) and got[5] == (1, 3, 0, 0, 3)


def test_input_errors_are_distinct(spark):
    raw = [None, "", "  \t\n ", "​", "!!!", "ok", " "]
    df = spark.createDataFrame(list(enumerate(raw)), "i int, t string").select("i", profile.input_error(F.col("t")).alias("e"))
    got = {r.i: r.e for r in df.collect()}
    assert got == {0: profile.INPUT_IS_NULL, 1: profile.INPUT_IS_BLANK, 2: profile.INPUT_IS_BLANK, 3: profile.NOTHING_READABLE, 4: None, 5: None, 6: profile.INPUT_IS_BLANK}


def test_change_rate_and_script_flags(spark):
    df = spark.createDataFrame([(1, "नवीन 5G Phone"), (2, "plain"), (3, "​"), (4, "भारत")], "ID int, Text string")
    prepared = prepare.prepare(df)
    assert prepared.count() == 4 and prepared.columns == ["ID", "Text", "Cleaned_Text"]
    rate = prepare.change_rate(prepared).first()
    assert (rate.n_rows, rate.n_changed, rate.n_empty, rate.changed_pct) == (4, 2, 1, 50.0)
    flags = prepare.script_flags(prepared).first()
    assert tuple(flags) == (2, 2, 1, 1)
    assert [r.ID for r in prepare.empty_after_cleaning(prepared).collect()] == [3]


def test_headline_column_is_the_fallback(spark):
    df = spark.createDataFrame([(1, "A  B")], "ID int, Headline string")
    assert prepare.prepare(df).first().Cleaned_Text == "a b"
    with pytest.raises(ValueError):
        prepare.prepare(spark.createDataFrame([(1,)], "ID int"))


def test_percentage(spark):
    df = spark.createDataFrame([(0.52901,), (1.0,), (0.0,)], "p double")
    assert [r.s for r in df.select(profile.percentage(F.col("p")).alias("s")).collect()] == ["52.90%", "100.00%", "0.00%"]
