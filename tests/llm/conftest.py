import pytest

from curbflow.session import scratch_dir

LONG = " ".join(f"word{k % 997}x{k}" for k in range(60_000))
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, kept boolean, score double, ledger string, "
    "ids string, decoded string, key string, node long, label int, chosen long, tie int, base string, n_tokens string"
)


def row(doc_id, text, lang="en", source="a"):
    return (doc_id, text, lang, source, None if text is None else len(text), True, 0.5, "x", "y", "z", "k", 1, 0, 2, 3, "b", "n")


@pytest.fixture(scope="session", autouse=True)
def shared_folder(spark):
    return scratch_dir(spark)


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty, blank and very long texts, repeated rows, and columns with clashing names."""
    prose = "the quick brown fox jumps over the lazy dog and then it runs far away from the noisy crowd of people today"
    rows = [
        row(1, prose), row(1, prose), row(2, prose), row(3, None), row(4, ""), row(5, " \n\t "), row(6, LONG),
        row(7, LONG), row(None, prose), row(None, None), row(8, "x" * 50_000), row(9, "é中文 😀 token = \"abcdef12345\""),
        row(10, prose + " again", None, None), row(11, "a b"), (12, *[None] * 16),
    ]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def make_docs(spark):
    def make(*texts, first=0):
        return spark.createDataFrame([row(first + k, t) for k, t in enumerate(texts)], SCHEMA)

    return make


@pytest.fixture
def as_table(spark, tmp_path):
    """A folder with documents and labels of the given rows, as queries read them."""

    def put(docs, labels=(), items=((0, "quick brown fox"),)):
        tables = {
            "documents": docs,
            "labels": spark.createDataFrame(list(labels), "doc_id long, quality int, toxic int"),
            "pages": docs.selectExpr("doc_id as page_id", "source as url", "text as html"),
            "benchmark": spark.createDataFrame(list(items), "item_id long, text string"),
        }
        for name, rows in tables.items():
            rows.write.parquet(f"{tmp_path}/{name}.parquet")
        return str(tmp_path)

    return put
