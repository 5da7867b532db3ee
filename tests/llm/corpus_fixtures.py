"""Documents for the tests of this folder."""

import public_tokenizers
import pytest

LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(30_000))


@pytest.fixture
def docs(spark):
    """Makes documents with extra columns whose names the operators use inside."""

    def make(rows):
        kinds = "doc_id long, text string, lang string, source string, n_chars long"
        extra = ", row string, size string, block long, d string, node string, label string, h int, kept_text string"
        filled = [tuple(r) + (None,) * (5 - len(r)) + ("r", "s", 1, "d", "n", "l", 2, "k") for r in rows]
        return spark.createDataFrame(filled, kinds + extra)

    return make


@pytest.fixture
def messy():
    """Null and empty values, white space, repeated rows, ties and a very long text."""
    return [
        (1, None, None, None),
        (2, "", "en", "a"),
        (3, " \t\n ", "en", "a"),
        (4, "one two", None, "a"),
        (4, "one two", None, "a"),
        (None, "a text without an id, yet with words enough for a shingle", "en", None),
        (6, LONG, "en", "b"),
        (7, LONG + " end", "de", "b"),
        (8, "12345 67890 !!!", "fr", "b"),
        (9, "Line one has words\nLine two has words\n\nLine one has words\nLine two has words", "en", "b"),
    ]


@pytest.fixture(scope="session")
def tokenizer():
    return public_tokenizers.path("byte_bpe_50k.json")
