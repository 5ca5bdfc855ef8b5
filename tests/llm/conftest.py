import pytest

#: Rows that every text operator must take: null and empty texts, ties, repeated rows, null ids, long words.
ODD = [
    (None, "no id here but words", "en", None),
    (3, None, None, "b"),
    (4, "", "en", "a"),
    (5, " \t\n ", "en", "a"),
    (6, "same words in this text, twice over, again and again", "en", "a"),
    (6, "same words in this text, twice over, again and again", "en", "a"),
    (7, "SAME words in this text, twice over, again and again", "de", "c"),
    (8, "x" * 20_000, "en", "é"),
    (9, "one\x0btwo\x0cthree\xa0four ｆive\n\nsix 日本 😀", "ja", "b"),
    (10, "the cat and the dog " * 2_000, "en", "c"),
]


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(ODD, "doc_id long, text string, lang string, source string")


@pytest.fixture(scope="session")
def none(odd):
    return odd.where("false")
