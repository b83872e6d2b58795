import pytest

SF0001 = "/root/testdata/sf0.001"
SF001 = "/root/testdata/sf0.01"

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, ids string"


def rows():
    """Nulls in any column, empty and long texts, ties, repeated rows, and columns named like results."""
    long_text = " ".join(f"word{k % 977} und" for k in range(40_000))
    prose = "The quick brown fox jumps over the lazy dog while nine other animals look on and say nothing at all."
    return [
        (1, prose, "en", "a/x", 10, 0.5, "i"),
        (2, prose + " Really.", "en", "a/y", 10, None, None),
        (3, None, None, None, None, None, None),
        (4, "", "en", "b", 0, 1.0, "j"),
        (5, long_text, "de", "b", 1, 1.0, "k"),
        (6, long_text + " ende", "de", "b", 1, 1.0, "k"),
        (7, "été à l'école, où ça va très bien 𝒳𝒴 一二三 \u0085   <|endoftext|>", "fr", "c", 3, 1.0, None),
        (8, prose, "en", "a/x", 10, 0.5, "i"),
        (8, prose, "en", "a/x", 10, 0.5, "i"),
        (None, "no id here but some words to read", "en", "d", 2, 0.1, None),
        (9, "   \n\t  ", None, "d", 2, 0.1, None),
    ]


@pytest.fixture()
def odd(spark):
    return spark.createDataFrame(rows(), SCHEMA)


@pytest.fixture()
def none(spark):
    return spark.createDataFrame([], SCHEMA)
