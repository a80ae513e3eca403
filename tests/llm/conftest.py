import random

import pytest

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns that operators use inside, given to their input as strangers.
CLASH = ("_id", "_size", "_times", "_source", "size", "fp", "did", "tk", "key", "found", "row", "copy", "score", "lang_pred", "n_words", "_words", "level", "t")


def sentence(rng, n, words="the of and to in a is that for it with as was on be at by this have from or one had not but what all were when we there can an your which their said if do will each about how up out them".split()):
    return " ".join(rng.choice(words) + rng.choice(["", "", "s", "ed", "ing", "ly"]) for _ in range(n))


def rows_of(n=60, seed=3):
    """Documents with nulls, empty, blank and long texts, repeated rows and copies."""
    rng = random.Random(seed)
    out = [(i, sentence(rng, rng.randint(5, 120)), rng.choice(["en", "fr", None]), rng.choice(["a", "b", "c", None, "é"]), 0) for i in range(n)]
    out[3] = (3, out[2][1], "en", "a", 0)
    out[4] = (4, out[2][1] + " more", "en", "a", 0)
    out += [(n, None, None, None, None), (n + 1, "", "en", "a", 0), (n + 2, " \t\n ", None, "b", 3), (None, out[5][1], "en", None, 0), (None, None, None, None, None)]
    out += [out[7], out[7]]
    out.append((n + 3, sentence(rng, 20_000), "en", "a", 0))
    out.append((n + 4, "word " * 300, "en", "b", 0))
    return out


@pytest.fixture(scope="session")
def messy(spark):
    return spark.createDataFrame(rows_of(), DOCUMENTS).cache()


@pytest.fixture(scope="session")
def strange(messy):
    """The same with extra columns of clashing names."""
    from pyspark.sql import functions as F

    return messy.withColumns({c: F.lit(7) for c in CLASH})


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCUMENTS)
