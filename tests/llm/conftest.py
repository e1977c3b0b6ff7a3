import pytest

SF = "/root/testdata/sf0.001"
DOC = "doc_id bigint, text string, lang string, source string, n_chars bigint"

TEXTS = [None, "", "  \n\t ", "one", "a b", "A b C", "a b c a b c a b c d", "x " * 3000, "long " + "wörd" * 5000, "same text here twice", "same text here twice", "line one here\nline one here\n\nline one here", "Ünï çödé — “quotes” 数据 🎉 and more words"]


@pytest.fixture
def odd(spark):
    """Nulls in any column, empty, blank and very long texts, ties, repeated rows and clashing extra columns."""
    rows = [(i if i % 5 else None, t, None if i % 3 == 0 else "en", None if i % 4 == 0 else "s", None, 7, "mine") for i, t in enumerate(TEXTS)]
    rows += rows[9:11] + [(3, "another text under a taken id", "en", "s", 1, 7, "mine")]
    return spark.createDataFrame(rows, DOC + ", shard int, fp string")


@pytest.fixture
def none(spark):
    return spark.createDataFrame([], DOC)


@pytest.fixture
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")
