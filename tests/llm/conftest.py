import pytest

from tiffin.llm.common import ship_package

SF = "/root/testdata/sf0.001"

#: Names that the operators use for columns of their own.
CLASHING = "n long, kept boolean, score double, lang_pred string, size long, slice int, pos long, ids binary, fp long, root long, copies long, rid long, _text string, _row string, target double, rows long"


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship_package(spark)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Nulls in any column, empty, blank and very long texts, ties, repeated rows and extra columns."""
    long_text = " ".join(f"w{i % 7919}x{i % 13}" for i in range(120_000))
    rows = [
        (1, "alpha beta gamma delta", "en", "a"),
        (1, "alpha beta gamma delta", "en", "a"),
        (2, "alpha beta gamma delta", "en", "b"),
        (2, "another text with the same id", None, None),
        (3, None, "en", "a"),
        (None, "no id at all here", "fr", "a"),
        (None, None, None, None),
        (4, "", "", ""),
        (5, " \t\n\x0b\x0c\r ", "en", "é"),
        (6, "one", "en", "a"),
        (7, "tab\tand  two spaces\n\nand \n mixed\r\n<|endoftext|> 日本語 naïve 🙂", "en", "b"),
        (8, long_text, "en", "b"),
        (9, "123 456 !!! ???", "en", "z"),
        (10, "Released under the MIT License.\nRELEASED under the mit license", "en", "a"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    return df.selectExpr("*", "length(text) as n_chars", *[f"cast(null as {k}) as {c}" for c, k in (x.split() for x in CLASHING.split(", "))])


@pytest.fixture(scope="session")
def no_documents(odd_documents):
    return odd_documents.limit(0)
