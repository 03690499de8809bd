import duckdb
import pytest

from salesflow.llm.queries import reachable

SF = "/root/testdata/sf0.001"


@pytest.fixture(autouse=True)
def workers(spark):
    reachable(spark)


@pytest.fixture(scope="session")
def small():
    """Rows of a table of the smallest data set: ``small("documents", "doc_id, text")``."""

    def rows(table, columns):
        return duckdb.sql(f"select {columns} from '{SF}/{table}.parquet' order by 1").fetchall()

    return rows


@pytest.fixture
def odd(spark):
    """Documents with nulls in every column, odd texts, repeats and extra columns."""
    long = "word other third " * 40_000
    data = [
        (1, "One two three four five six seven eight.", "en", "a"),
        (1, "One two three four five six seven eight.", "en", "a"),
        (2, None, "en", "a"),
        (3, "", None, None),
        (4, "   \t \n ", "fr", ""),
        (None, "One two three four five six seven eight.", "en", None),
        (5, "12 34 !?", "de", "b"),
        (6, "a\x00b\x1cc ퟿ é <|endoftext|>", "fr", "b"),
        (7, long, "en", "hot"),
        (8, "Und der die das nicht mit von", "de", "hot"),
        (9, None, None, None),
    ]
    rows = [(*r, len(r[1] or ""), "x", 0.5, 7) for r in data]
    schema = (
        "doc_id bigint, text string, lang string, source string, n_chars bigint, "
        "copies string, score double, target int"
    )
    return spark.createDataFrame(rows, schema)
