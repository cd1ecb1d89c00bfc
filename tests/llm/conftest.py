import pytest


@pytest.fixture(scope="session")
def run_query(spark, sf_dir):
    """A registered query's rows over the smallest tables, each run once."""
    from labelweave.llm.queries import QUERIES
    kept = {}

    def run(name):
        if name not in kept:
            kept[name] = QUERIES[name](spark, sf_dir).toPandas()
        return kept[name]
    return run


@pytest.fixture(scope="session")
def read(sf_dir):
    import pandas as pd
    return lambda name: pd.read_parquet(f"{sf_dir}/{name}.parquet")


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Nulls, empty and very long texts, ties, repeated rows, clashing names."""
    rows = [(1, None, "en", "a", None, "x"), (2, "", None, None, 0, "x"), (3, " \n\t ", "en", "a", 4, None),
            (4, "one two three", "de", None, 13, "x"), (4, "one two three", "de", None, 13, "x"),
            (5, "word " * 30000, "en", "b", 150000, "x"), (None, "no number here at all", "en", "b", 21, "x"),
            (6, "x" * 20000, "en", "b", 20000, "x"), (7, "é日本 \U0001F600 ß", None, "b", 6, "x"),
            (8, " ".join(f"w{i}" for i in range(300)), "fr", "c", 1000, "x"),
            (9, " ".join(f"w{i}" if i != 50 else "other" for i in range(300)), "fr", "c", 1000, "x")]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, size string")
