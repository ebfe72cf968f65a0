"""Rank-order language profiles against distances computed the plain way."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from fabgauge.llm import languages

ALPHABETS = {"aa": "abcdefg", "bb": "efghijk", "cc": "ijklmno"}
SCHEMA = "doc_id long, text string, lang string"


def prose(lang, seed, words):
    """Words of a language; its earlier letters are more frequent."""
    rng = random.Random(f"{lang}{seed}")
    letters = ALPHABETS[lang]
    weights = range(len(letters), 0, -1)
    return " ".join("".join(rng.choices(letters, weights, k=rng.randint(2, 6))) for _ in range(words))


def corpus(per_language=12):
    langs = list(ALPHABETS)
    return [(i, prose(langs[i % 3], i, 5 + 9 * (i % 7)), langs[i % 3]) for i in range(3 * per_language)]


def plain_grams(text):
    """n-grams of one to three characters in words with one space at both ends, as the module counts them."""
    edged = " " + " ".join(text.split()) + " "
    singles = [c for c in edged if c != " "]
    pairs = [edged[i : i + 2] for i in range(len(edged) - 1)]
    triples = [edged[i : i + 3] for i in range(len(edged) - 2) if edged[i + 1] != " "]
    return [*singles, *pairs, *triples]


def code(gram):
    """Order among equally frequent n-grams: the module's number of a gram."""
    value = 0
    for c in gram:
        value = (value << 10) | (1 if c == " " else 2 + ord(c) % languages.LETTERS)
    return value


def plain_ranks(counts, size):
    return sorted(counts, key=lambda g: (-counts[g], code(g)))[:size]


def plain_predict(profiles, text, size):
    mine = plain_ranks(Counter(plain_grams(text)), size)
    best = None
    for lang in sorted(profiles):
        places = {g: i for i, g in enumerate(profiles[lang])}
        distance = sum(abs(places[g] - i) if g in places else size for i, g in enumerate(mine))
        if best is None or distance < best[0]:
            best = (distance, lang)
    return best[1], 1 - best[0] / (size * len(mine))


@pytest.mark.parametrize("size", [20, 400])
def test_equal_to_plain_distances(spark, size):
    rows = corpus()
    learned = languages.learn_profiles(spark.createDataFrame(rows, SCHEMA), size=size)
    counts = {lang: Counter() for lang in ALPHABETS}
    for _, text, lang in rows:
        counts[lang].update(plain_grams(text))
    plain = {lang: plain_ranks(c, size) for lang, c in counts.items()}
    assert {lang: list(p) for lang, p in learned.items()} == {lang: [code(g) for g in p] for lang, p in plain.items()}
    ranks = languages.Ranks(learned, size)
    for i in range(40):
        text = prose(list(ALPHABETS)[i % 3], f"asked{i}", 1 + i) + " " + prose("bb", i, i % 9)
        lang, score = ranks.predict(text)
        wanted = plain_predict(plain, text, size)
        assert (lang, score) == (wanted[0], pytest.approx(wanted[1]))


def test_ties_go_to_the_first_language(spark):
    rows = [(1, "abc abd", "zz"), (2, "abc abd", "mm"), (3, "xyz", "aa")]
    profiles = languages.learn_profiles(spark.createDataFrame(rows, SCHEMA))
    asked = spark.createDataFrame([(9, "abc abd"), (9, "abc abd")], "doc_id long, text string")
    found = languages.identify_languages(asked, profiles).collect()
    assert [(r.lang_pred, r.score) for r in found] == [("mm", 1.0)] * 2


def test_repeated_rows_count_once(spark):
    rows = corpus()
    once = languages.learn_profiles(spark.createDataFrame(rows, SCHEMA))
    often = languages.learn_profiles(spark.createDataFrame(rows + rows[:1] * 500, SCHEMA))
    assert {k: list(v) for k, v in once.items()} == {k: list(v) for k, v in often.items()}
    null = spark.createDataFrame([*rows, (None, "qqq", "aa"), (7, None, "aa"), (8, "qqq", None)], SCHEMA)
    again = languages.learn_profiles(null.withColumns({"share": F.lit(1), "hash": F.lit("x"), "n": F.lit(0)}))
    assert {k: list(v) for k, v in once.items()} == {k: list(v) for k, v in again.items()}


def test_sample_is_that_of_the_smallest_hashes(spark):
    """20,000 ids of one language and few of others; the limit leaves enough of each."""
    many = spark.range(20_000).selectExpr(
        "id AS doc_id", "concat('w', CAST(id AS STRING)) AS text", "IF(id % 1000 = 0, 'bb', 'aa') AS lang"
    )
    chosen = [
        r.doc_id
        for lang in ("aa", "bb")
        for r in many.where(f"lang = '{lang}'").orderBy(F.xxhash64("doc_id")).limit(50).collect()
    ]
    whole = languages.learn_profiles(many.where(F.col("doc_id").isin(chosen)))
    limited = languages.learn_profiles(many, per_language=50)
    assert {k: list(v) for k, v in limited.items()} == {k: list(v) for k, v in whole.items()}
