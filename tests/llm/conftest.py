import pytest


def table(spark, rows, schema):
    """A small table over several partitions."""
    return spark.createDataFrame(rows, schema).repartition(3)


@pytest.fixture
def edge_docs(spark):
    """Documents with nulls, empty and long texts, ties, repeats and clashing extra columns."""
    long_text = " ".join(f"word{i % 977} other{i % 313}" for i in range(30_000))
    rows = [
        (1, "The quick brown fox jumps over the lazy dog near the old river bank today.", "en", 1.0, "x"),
        (2, None, None, None, None),
        (3, "", "en", 0.0, "y"),
        (4, long_text, "en", 2.0, None),
        (5, "The quick brown fox jumps over the lazy dog near the old river bank today.", None, 1.0, "x"),
        (5, "The quick brown fox jumps over the lazy dog near the old river bank today.", None, 1.0, "x"),
        (None, "A text without an id stands here, with enough words to be read by all.", "fr", None, "z"),
        (7, " \t\n ", "de", 3.0, "w"),
        (8, "ünïcödé ẞ 漢字 😀 \u00a0 end\x0bof\x1cit", "de", 3.0, "w"),
    ]
    # score, spans, fp and the like are names that operators use themselves
    return table(spark, rows, "doc_id long, text string, lang string, score double, fp string")


@pytest.fixture
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, score double, fp string")
