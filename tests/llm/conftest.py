import pytest

ROWS = [
    (1, "The quick brown fox jumps over the lazy dog, again and again.\nshort\nThe quick brown fox jumps over the lazy dog, again and again."),
    (2, "the QUICK brown fox jumps over the lazy dog, again and again. \nother"),
    (3, "  The quick brown fox jumps over the lazy dog, again and again."),
    (4, "The quick brown fox jumps over the lazy dog, again and again."),
    (5, "The quick brown fox jumps over the lazy dog, again and again."),
    (5, "The quick brown fox jumps over the lazy dog, again and again."),  # a repeated row
    (6, None),
    (7, ""),
    (None, "A row without an id, whose line is long enough to count."),
    (8, "日本語のテキスト 👩‍👩‍👧 naïve 'll don't \x1c\x85\xa0 end"),
    (9, "word " * 3000),
    (10, "x" * 3000 + "!" * 1500),
    (11, " \n\t \n "),
]


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and long texts, ties, repeated rows, and a column whose name clashes with those the operators make."""
    rows = [(i, t, "en", f"s{n % 2}", len(t or ""), n, "x", 0) for n, (i, t) in enumerate(ROWS)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, row int, drops string, held_out int").repartition(3)


@pytest.fixture(scope="session")
def empty(odd):
    return odd.limit(0)


@pytest.fixture(scope="session")
def docs(spark, data):
    return spark.read.parquet(f"{data}/documents.parquet")


@pytest.fixture(scope="session")
def labels(spark, data):
    return spark.read.parquet(f"{data}/labels.parquet")


@pytest.fixture(scope="session")
def vocabulary():
    return pytest.importorskip("public_tokenizers")
