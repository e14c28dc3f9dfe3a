import pytest

TEXTS = [
    (1, "The quick brown fox jumps over the lazy dog again and again.\nA second line that is long enough to count.", "en"),
    (2, "The quick brown fox jumps over the lazy dog again and again.\nA second line that is long enough to count.", "en"),
    (3, "Der schnelle braune Fuchs springt über den faulen Hund.\nUnd noch eine Zeile, die lang genug ist.", "de"),
    (4, "", "en"),
    (5, None, None),
    (6, "   \n\t ", "de"),
    (None, "A row without an id but with a text of some words.", "en"),
    (7, "one", None),
    (7, "one", None),
    (8, "42 %% 17 && ## 1234567", "en"),
    (9, "word " * 30_000, "en"),
]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and long texts, repeated rows, and extra columns with names that operators use themselves."""
    rows = [(i, t, g, f"s{(i or 0) % 2}" if i != 3 else None, len(t or ""), -1.0, "mine", i) for i, t, g in TEXTS]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, score double, label string, id long"
    )


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
