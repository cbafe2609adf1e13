import tempfile

import pytest


@pytest.fixture(scope="session", autouse=True)
def checkpoint_folder(spark):
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.conf.set("spark.checkpoint.dir", "file://" + tempfile.mkdtemp(prefix="llm-tests-"))


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and long texts, repeated rows and ids, an extra column with a clashing name."""
    base = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon "
    long = " ".join(f"word{i % 997}x{i % 13}" for i in range(30_000))
    rows = [(1, base * 4, "en", "a", 1), (1, base * 4, "en", "a", 1), (2, base * 4 + "end", "en", "b", 2),
            (3, None, None, None, None), (None, base * 3 + "other words at the end of it all", "de", None, 3),
            (4, "", "en", "a", 0), (5, long, "fr", "c", 9), (6, long + " tail", "fr", "c", 9), (7, " \n\n\t ", "en", "b", 5),
            (None, None, None, None, None), (8, "short", "en", "b", 5), (9, "short", "en", "b", 5),
            (10, "x\n" + base + "\n" + base.replace("mu", "mi") + "\n| | | |\nend", "en", "a", 3)]
    schema = "doc_id long, text string, lang string, source string, size long"
    return spark.createDataFrame(rows, schema)
