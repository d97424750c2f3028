import random

import pytest

SCHEMA = "doc_id long, text string, lang string, row string, hash long, keys string, node int, source string"
WORDS = "the of and in to a is was for on that with as by at from water stone river light house green winter summer table paper".split()


def sentence(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", "s", "ing", "er", "ed"]) for _ in range(n)).capitalize() + "."


@pytest.fixture(scope="session")
def awkward(spark):
    """Nulls in all columns, empty and long texts, repeated rows, and columns whose names operators use inside."""
    rng = random.Random(7)
    long = "\n".join(sentence(rng, 40) for _ in range(1500))
    base = sentence(rng, 120)
    texts = [
        None, "", " ", "\n", "\n\n", "one", "One two", base, base, base.replace("water", "wine", 1), long, long + " tail",
        "Same line\nown a", "same line \nown b", "\tSAME LINE\nown c", "é ́ ̈ äöü ÉÀ", "x\x00y \x1c z", "😀 text 𝒳", "  ", "1234 !!",
    ]
    rows = [(k, t, "en", "r", k, "k", 1, "s") for k, t in enumerate(texts)]
    rows += [(7, base, "en", "r", 1, "k", 1, "s"), (None, base, None, None, None, None, None, None), (None, None, None, None, None, None, None, None), (3, "other text", "de", "r", 1, "k", 1, "s")]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def vocabulary():
    from granero.llm.tokens import vocabulary_path

    return vocabulary_path()
