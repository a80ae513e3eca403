import zlib

import numpy as np
import pytest
from framelake.llm import langid

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LETTERS = {"xx": "abcdef", "yy": "uvwxyz", "zz": "äöüßéè"}


def labelled(n=240):
    rng = np.random.default_rng(1)
    out = []
    for i in range(n):
        lang = list(LETTERS)[i % 3]
        words = ["".join(rng.choice(list(LETTERS[lang] + "nost"), 5)) for _ in range(rng.integers(3, 40))]
        out.append((i, " ".join(words), lang, "s", 0))
    return out


@pytest.fixture(scope="module")
def docs(spark):
    rows = labelled() + [(1000, None, "xx", "s", 0), (1001, "12 34 !!", "xx", "s", 0), (1002, "", None, None, 0), (None, "abc fed", None, "s", 0), (1003, "ABC fed " * 30_000, None, "s", 0)]
    return spark.createDataFrame(rows, SCHEMA)


def test_held_out_accuracy(docs):
    rows = {r["doc_id"]: r for r in langid.identify(docs).collect()}
    truth = {r[0]: r[2] for r in labelled()}
    assert len(rows) == docs.count()
    held = [i for i in truth if rows[i]["held_out"]]
    assert len(held) > 40 and all(rows[i]["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2) for i in truth)
    assert np.mean([rows[i]["lang_pred"] == truth[i] for i in held]) > 0.95
    assert all(0 <= r["score"] <= 1 for r in rows.values())
    assert [rows[i]["lang_pred"] for i in (1000, 1001, 1002)] == ["und"] * 3
    assert rows[1003]["lang_pred"] == rows[None]["lang_pred"] == "xx"


def test_lang_and_source_are_no_inputs_of_predictions(docs):
    from pyspark.sql import functions as F

    model = langid.train(docs)
    a = sorted(langid.predict(docs, model).collect(), key=str)
    b = sorted(langid.predict(docs.withColumns({"lang": F.lit("yy"), "source": F.lit("q")}).repartition(3), model).collect(), key=str)
    assert [(r[0], r[1]) for r in a] == [(r[0], r[1]) for r in b]


def test_reruns_agree(docs):
    a, b = langid.train(docs), langid.train(docs.repartition(5))
    assert a.languages == b.languages and np.allclose(a.weights, b.weights)


def test_neighbours_do_not_matter():
    texts = ["Ab, cd!", "", "  ", "é1É", "x", "longer text here"]
    buckets, spans, letters = langid.grams_of(texts)
    assert letters.tolist() == [True, False, False, True, True, True]
    for i, t in enumerate(texts):
        one, span, _ = langid.grams_of([t])
        for n in range(len(langid.ORDERS)):
            assert buckets[n][slice(*spans[n][i])].tolist() == one[n][slice(*span[n][0])].tolist()
    model = langid.Model(["a", "b"], np.random.default_rng(0).normal(size=(langid.BUCKETS, 2)).astype(np.float32), np.zeros(2), 1.0)
    together = langid.probabilities(model, texts)[0]
    alone = np.concatenate([langid.probabilities(model, [t])[0] for t in texts])
    assert np.allclose(together, alone)


def test_temperature_is_the_best_of_the_grid():
    rng = np.random.default_rng(2)
    scores = rng.normal(size=(300, 3)) * 4
    labels = np.array([rng.choice(3, p=langid.softmax(s / 3.0)) for s in scores])
    assert 1.5 < langid.fit_temperature(scores, labels) < 6


def test_without_labels_and_without_rows(docs, empty, strange):
    from pyspark.sql import functions as F

    none = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r["lang_pred"] for r in langid.identify(none).collect()} == {"und"}
    assert langid.identify(empty).count() == 0 and langid.in_known_language(empty).count() == 0
    kept = langid.in_known_language(strange)
    assert kept.columns == strange.columns and 0 < kept.count() <= strange.count()


def test_rows_of_one_id_are_judged_by_their_own_text(spark, docs):
    rows = [(500, "abc fed abc", "en", "s", 0), (500, "1234 !!!", "en", "s", 0), (None, "12", None, "s", 0), (None, "abc def", None, "s", 0), (500, None, None, None, None)]
    more = docs.union(spark.createDataFrame(rows, SCHEMA))
    kept = [tuple(r) for r in langid.in_known_language(more).where("doc_id = 500 OR doc_id IS NULL").collect()]
    assert sorted(r[1] for r in kept) == ["abc def", "abc fed", "abc fed abc"]


def test_sample_is_bounded_and_whole_where_small(spark):
    """Many copies of few texts: the different ones are all sampled; a frequent language gives about the number asked for."""
    rows = [(i, " ".join("abcdef"[(i * 7 + k) % 6] * 2 for k in range(i % 9 + 2)), "few", "s", 0) for i in range(40)] * 60 + [(i, " ".join("uvwxyz"[(i >> k) % 6] * 3 for k in range(5)), "many", "s", 0) for i in range(2000)]
    model = langid.train(spark.createDataFrame(rows, SCHEMA), per_language=50)
    assert model.languages == ["few", "many"]
    p, _ = langid.probabilities(model, ["aa bb cc dd", "uuu vvv www"])
    assert p.argmax(axis=1).tolist() == [0, 1]
    assert langid.train(spark.createDataFrame(rows, SCHEMA), per_language=50, languages=1).languages == ["many"]


def test_ftrl_equals_coordinate_by_coordinate():
    rng = np.random.default_rng(4)
    rows = []
    for _ in range(30):
        at = np.append(np.sort(rng.choice(50, 6, replace=False)), langid.BUCKETS)
        rows.append((at, np.append(rng.random(6), 1.0), int(rng.integers(3))))
    alpha, beta, l1, l2 = 0.5, 1.0, 1e-2, 1e-3
    z, n = {}, {}

    def weight(i, c):
        zi, ni = z.get((i, c), 0.0), n.get((i, c), 0.0)
        return 0.0 if abs(zi) <= l1 else -(zi - (l1 if zi > 0 else -l1)) / ((beta + ni**0.5) / alpha + l2)

    order = np.random.default_rng(5)
    for _ in range(2):
        for k in order.permutation(len(rows)):
            at, x, y = rows[k]
            w = {(i, c): weight(i, c) for i in at.tolist() for c in range(3)}
            scores = [sum(w[i, c] * v for i, v in zip(at.tolist(), x.tolist())) for c in range(3)]
            top = max(scores)
            e = [np.exp(v - top) for v in scores]
            for c in range(3):
                slope = e[c] / sum(e) - (c == y)
                for i, v in zip(at.tolist(), x.tolist()):
                    g, old = slope * v, n.get((i, c), 0.0)
                    z[i, c] = z.get((i, c), 0.0) + g - ((old + g * g) ** 0.5 - old**0.5) / alpha * w[i, c]
                    n[i, c] = old + g * g
    got = langid.fit_ftrl(rows, 3, epochs=2, alpha=alpha, beta=beta, l1=l1, l2=l2)
    assert all(abs(got[i, c] - weight(i, c)) < 1e-9 for i in [*range(50), langid.BUCKETS] for c in range(3)) and (got == 0).any()


def test_weights_hold_the_idf_of_all_labelled_documents(spark):
    texts = ["ab", "ab cd", "cd", "ef", None, "12"]
    rows = [(i, t, "xx" if i % 2 else "yy", "s", 0) for i, t in enumerate(texts)]
    rows = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 4 != 2]
    model = langid.train(spark.createDataFrame(rows, SCHEMA))
    kept = [r[1] for r in rows if r[1] and any(c.isalpha() for c in r[1])]
    grams = lambda t: {g for n in langid.ORDERS for g in (f" {t} "[i : i + n] for i in range(len(t) + 3 - n))}
    buckets, spans, _ = langid.grams_of(["ab"])
    own = {int(b) for x, f in zip(buckets, spans) for b in x[f[0, 0] : f[0, 1]]}
    seen = {g: sum(g in grams(t) for t in kept) for g in grams("ab")}
    assert len(own) <= len(seen) and model.weights.shape == (langid.BUCKETS, len(model.languages)) and max(seen.values()) <= len(kept)
