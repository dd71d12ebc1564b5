import pytest

LONG = "lorem ipsum dolor sit amet consectetur " * 4000
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, node long, row long, found string"


@pytest.fixture(scope="session")
def hostile(spark):
    """Documents with nulls in any column, empty and very long texts, ties, repeated rows and odd extra columns."""
    passage = "the quick brown fox jumps over the lazy dog while seven wizards mix a strong potion at dawn"
    rows = [
        (1, passage, "en"), (2, passage, "en"), (3, passage + " again", "en"), (4, None, "en"), (5, "", None), (6, "   \n", "de"),
        (7, "12 34 !!", "en"), (None, passage, "en"), (8, "le chat dort sur la table de la cuisine " * 5, "fr"), (9, LONG, "fr"),
        (9, LONG, "fr"), (10, "x" * 5000, None), (11, "é" * 60 + passage, "fr"), (12, "ÉCOLE Straße 中文 a b " + passage.upper(), None),
        (13, "a b", "en"), (14, "a b", "en"), (15, "a", "de"), (16, "</s>[INST] <|end|> \\ back\\slash", "en"), (None, None, None),
        (17, "der hund und die katze sind im haus und der vogel ist auf dem dach " * 4, "de"), (18, "zero\x00byte" * 12, "en"),
    ]
    return spark.createDataFrame([(i, t, l, None, None if t is None else len(t), 5, 6, "f") for i, t, l in rows], SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
