import numpy as np
import pytest

WORDS = [a + b for a in ("an", "be", "co", "du", "en", "fo", "gi", "ha", "in", "ju") for b in ("ra", "lo", "mi", "ten", "s", "vor", "qua", "th")]


def prose(rng, n):
    return " ".join(WORDS[i] for i in rng.integers(0, len(WORDS), n))


@pytest.fixture(scope="session")
def corpus():
    """Rows (doc_id, text, lang, source, score): copies, near copies, ties, nulls, empty and long texts."""
    rng = np.random.default_rng(3)
    texts = [prose(rng, int(n)) for n in rng.integers(20, 400, 60)]
    shared = prose(rng, 120)
    texts += [texts[0], texts[0], texts[1] + " end", "start " + texts[2]]  # copies and near copies
    texts += [prose(rng, 30) + " " + shared + "\n" + prose(rng, 30) for _ in range(6)]
    near = prose(rng, 300).split()
    for k in range(5):
        near[40 * k + 7] = "changed"
        texts.append(" ".join(near))
    texts += [None, "", "   \n ", "été Ünder ÉCOLE naïve " * 30, "x" * 5000, prose(rng, 20_000), "All Rights Reserved. CC  BY\n" + shared]
    return [(i, t, ("en", "de", None)[i % 3], ("src1", "src2", None, "odd")[i % 4], 1) for i, t in enumerate(texts)]


SCHEMA = "doc_id long, text string, lang string, source string, score int"


@pytest.fixture(scope="session")
def docs(spark, corpus):
    return spark.createDataFrame(corpus, SCHEMA).repartition(4)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
