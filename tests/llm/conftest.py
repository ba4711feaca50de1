import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, _id int, _key string, score double, n string"


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table from (id, text, lang, source), with extra columns whose names the operators use themselves."""
    def build(rows):
        full = [(i, t, lang, source, len(t or ""), 1, "k", 0.5, "n") for i, t, lang, source in rows]
        return spark.createDataFrame(full, DOCS).repartition(3)
    return build


def words(seed: int, n: int) -> str:
    pick = random.Random(seed)
    return " ".join("".join(pick.choice("abcdefghij") for _ in range(pick.randint(2, 7))) for _ in range(n))


@pytest.fixture(scope="session")
def odd_docs(docs_of):
    """Null, empty, blank, repeated and long texts, null columns and a null id."""
    long = words(1, 6000)
    return docs_of([(1, None, None, None), (2, "", "en", "a"), (3, " \n\t ", "en", "a"), (4, "one two", "en", None),
                    (5, "one two", "de", "b"), (5, "one two", "de", "b"), (6, long, "en", "a"), (7, long, "en", "a"),
                    (8, long + " tail", None, "a"), (None, long, "en", "a"), (None, None, None, None),
                    (9, "12 34 !!", "en", "a"), (10, "é Ünïcode ß 𝛼 " * 40, "de", "a")])


@pytest.fixture(scope="session")
def no_docs(docs_of, spark):
    return spark.createDataFrame([], DOCS)
