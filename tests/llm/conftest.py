import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def make(spark):
    """make([(doc_id, text), ...] or full rows) -> documents frame."""

    def build(rows, schema=SCHEMA):
        full = [(*r, "en", "s", len(r[1] or "")) if len(r) == 2 else r for r in rows]
        return spark.createDataFrame(full, schema)

    return build


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def odd(make):
    """Nulls everywhere, empty and long texts, ties, repeated rows."""
    long = "the cat sat on mats " * 20_000
    return make([(1, None, None, None, None), (None, "a b c", "en", None, 5), (None, None, None, None, None), (2, "", "en", "s", 0),
                 (3, " \n\t ", "fr", "s", 3), (4, long, "en", "t", len(long)), (4, long, "en", "t", len(long)),
                 (5, "one two three four five", "en", "s", 23), (6, "one two three four five", "en", "s", 23),
                 (7, "éàü ñ 中文 \U0001f600", "es", "t", 8)])


@pytest.fixture(scope="session")
def empty(make):
    return make([])
