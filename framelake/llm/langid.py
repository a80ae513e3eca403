"""Language identification: multinomial logistic regression on TF-IDF character n-grams, trained with FTRL."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .io import keep_rows, null_ids, table, with_ids

#: Hashed n-grams of 1 to 3 characters; letters folded to lower case, runs of anything else to one space.
ORDERS, BUCKETS = (1, 2, 3), 1 << 15
#: The classifier is fitted on about this many labelled documents per language; IDF counts cover all of them.
SAMPLE_PER_LANGUAGE = 400
#: Languages that can be learned: those with the most labelled documents.
MOST_LANGUAGES = 256
#: Characters handled at once; a longer single text is handled alone.
CHUNK = 1 << 18
SPACE = 32
_tables: dict[str, np.ndarray] = {}


def fold_table() -> np.ndarray:
    """Code point to folded code point: letters to lower case, all else to a space."""
    if "fold" not in _tables:
        out = np.full(0x110000, SPACE, np.int32)
        for c in range(0x32400):  # assigned letters lie below
            x = chr(c)
            if x.isalpha():
                low = x.lower()
                out[c] = ord(low) if len(low) == 1 else c
        _tables["fold"] = out
    return _tables["fold"]


def chunk_ranges(texts: list[str]) -> Iterator[tuple[int, int]]:
    start = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t) > CHUNK:
            yield start, i
            start, size = i, 0
        size += len(t) + 2
    if start < len(texts):
        yield start, len(texts)


def grams_of(texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray]:
    """Per n-gram order: buckets of all n-grams, and (start, end) of each text's own; and which texts have letters.

    Every text stands between spaces of its own, and no n-gram reaches beyond them, so neighbours never matter.
    """
    folded = fold_table()[np.frombuffer(" \n".join(["", *texts, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)]
    offsets = np.cumsum([2, *[len(t) + 2 for t in texts]]) - 1  # the space before each text
    keep = np.concatenate([[True], (folded[1:] != SPACE) | (folded[:-1] != SPACE)])
    keep[offsets] = True
    place = np.concatenate([[0], np.cumsum(keep)])[offsets]
    codes = folded[keep].astype(np.uint64)
    letters = np.add.reduceat((folded != SPACE).astype(np.int64), offsets[:-1]) > 0 if len(texts) else np.empty(0, bool)
    buckets, spans = [], []
    with np.errstate(over="ignore"):
        for n in ORDERS:
            m = max(len(codes) - n + 1, 0)
            h = np.full(m, n, np.uint64)
            for j in range(n):
                h = (h + codes[j : j + m]) * np.uint64(0x9E3779B97F4A7C15)
                h ^= h >> np.uint64(29)
            buckets.append((h & np.uint64(BUCKETS - 1)).astype(np.int64))
            spans.append(np.stack([place[:-1], np.maximum(place[1:] - n + 1, place[:-1])], axis=1))
    return buckets, spans, letters


def _per_text(texts: list[str]) -> Iterator[tuple[np.ndarray, bool]]:
    """Bucket counts of each text, and whether it has a letter."""
    for a, b in chunk_ranges(texts):
        buckets, spans, letters = grams_of(texts[a:b])
        for i in range(b - a):
            own = np.concatenate([x[f[i, 0] : f[i, 1]] for x, f in zip(buckets, spans)])
            yield np.bincount(own, minlength=BUCKETS), bool(letters[i])


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray  # (BUCKETS, languages), IDF folded in
    bias: np.ndarray
    temperature: float


def fit_ftrl(rows: list[tuple[np.ndarray, np.ndarray, int]], classes: int, epochs: int = 4, alpha: float = 0.5, beta: float = 1.0, l1: float = 1e-4, l2: float = 1e-4):
    """Follow-the-regularised-leader (proximal) with elastic net; rows are (indices, values, class). Last index: bias."""
    z, n = np.zeros((BUCKETS + 1, classes)), np.zeros((BUCKETS + 1, classes))

    def weights(at):
        zi, ni = z[at], n[at]
        return np.where(np.abs(zi) <= l1, 0.0, -(zi - np.sign(zi) * l1) / ((beta + np.sqrt(ni)) / alpha + l2))

    order = np.random.default_rng(5)
    for _ in range(epochs):
        for i in order.permutation(len(rows)):
            at, x, y = rows[i]
            w = weights(at)
            p = softmax(x @ w)
            p[y] -= 1.0
            g = x[:, None] * p
            sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / alpha
            z[at] += g - sigma * w
            n[at] += g * g
    return weights(np.arange(BUCKETS + 1))


def softmax(scores: np.ndarray) -> np.ndarray:
    e = np.exp(scores - scores.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def fit_temperature(scores: np.ndarray, labels: np.ndarray) -> float:
    """The temperature from a fixed grid that gives the smallest log loss."""
    if not len(labels):
        return 1.0
    grid = np.geomspace(0.1, 20, 61)
    loss = [-np.log(np.maximum(softmax(scores / t)[np.arange(len(labels)), labels], 1e-12)).mean() for t in grid]
    return float(grid[int(np.argmin(loss))])


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE, languages: int = MOST_LANGUAGES) -> Model | None:
    """Fits on the labelled documents that are not held out; None if there are none with a letter.

    Document frequencies are counted over all of them; the weights come from a sample: the documents whose hash lies below
    ``per_language`` divided by the language's number of different documents, so that nothing is ranked and equal rows count
    once. A quarter of the sample fits the temperature only. What reaches the driver is bounded: the frequencies of BUCKETS
    buckets and the sparse vectors of about ``per_language`` documents in each of at most ``languages`` languages.
    """
    labelled = docs.where(~held_out() & F.col("lang").isNotNull() & F.col("text").isNotNull()).select(F.xxhash64("doc_id", "text").alias("h"), "text", "lang")

    def frequencies(batches):
        import pandas as pd

        seen, total = np.zeros(BUCKETS, np.int64), 0
        for batch in batches:
            for counts, letters in _per_text(batch["text"].tolist()):
                if letters:
                    seen += counts > 0
                    total += 1
        at = np.flatnonzero(seen)
        yield pd.DataFrame({"bucket": np.append(at, -1), "n": np.append(seen[at], total)})

    counted = labelled.select("text").mapInPandas(frequencies, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    total = int(counted.loc[counted["bucket"] < 0, "n"].sum())
    if not total:
        return None
    seen = np.zeros(BUCKETS)
    own = counted[counted["bucket"] >= 0]
    seen[own["bucket"].to_numpy()] = own["n"].to_numpy()
    idf = np.log((1 + total) / (1 + seen)) + 1

    def vectors(batches):
        import pandas as pd

        for batch in batches:
            out = []
            for lang, h, (counts, letters) in zip(batch["lang"], batch["h"], _per_text(batch["text"].tolist())):
                at = np.flatnonzero(counts)
                if letters:
                    out.append((lang, h, at.astype(np.int32).tobytes(), (counts[at] / counts.sum()).astype(np.float32).tobytes()))
            yield pd.DataFrame(out, columns=["lang", "h", "at", "share"])

    sizes = labelled.groupBy("lang").agg(F.approx_count_distinct("h").alias("n")).orderBy(F.desc("n"), "lang").limit(languages)
    below = F.shiftrightunsigned("h", 11).cast("double") * F.col("n") < float(per_language) * (1 << 53)
    sample = labelled.join(F.broadcast(sizes), "lang").where(below).dropDuplicates(["lang", "h"]).select("lang", "h", "text")
    rows = sample.mapInPandas(vectors, "lang string, h long, at binary, share binary").toPandas().sort_values(["lang", "h"])
    languages = sorted(rows["lang"].unique())
    code = {x: i for i, x in enumerate(languages)}
    at = [np.frombuffer(x, np.int32) for x in rows["at"]]
    shares = [np.frombuffer(x, np.float32) for x in rows["share"]]
    data = [(np.append(a, BUCKETS), np.append(s * idf[a], 1.0), code[x]) for a, s, x in zip(at, shares, rows["lang"])]
    part = rows.groupby("lang").cumcount().to_numpy() % 4
    fit = [d for d, p in zip(data, part) if p != 0] or data
    weights = fit_ftrl(fit, len(languages))
    rest = [d for d, p in zip(data, part) if p == 0]
    scores = np.array([x @ weights[a] for a, x, _ in rest]).reshape(len(rest), len(languages))
    temperature = fit_temperature(scores, np.array([y for *_, y in rest], int))
    return Model(languages, (weights[:-1] * idf[:, None]).astype(np.float32), weights[-1], temperature)


def probabilities(model: Model, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(probability per language, has a letter) of every text."""
    out, letters = [], []
    for a, b in chunk_ranges(texts):
        buckets, spans, own = grams_of(texts[a:b])
        sums, count = np.zeros((b - a, len(model.languages))), np.zeros(b - a)
        for x, f in zip(buckets, spans):
            some = np.flatnonzero(f[:, 1] > f[:, 0])
            if len(some):
                count[some] += (f[:, 1] - f[:, 0])[some]
                for k in range(len(model.languages)):
                    values = np.append(model.weights[:, k][x], np.float32(0))
                    sums[some, k] += np.add.reduceat(values, f[some].ravel(), dtype=np.float64)[::2]
        out.append(softmax((sums / np.maximum(count, 1)[:, None] + model.bias) / model.temperature))
        letters.append(own)
    return np.concatenate(out), np.concatenate(letters)


def _sent(docs: DataFrame, model: Model | None):
    """The model as a broadcast of plain values."""
    return docs.sparkSession.sparkContext.broadcast(model and (model.languages, model.weights, model.bias, model.temperature))


def _said(sent, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(language, probability) of every text."""
    if sent.value is None or not texts:
        return np.full(len(texts), "und", object), np.zeros(len(texts))
    model = Model(*sent.value)
    p, letters = probabilities(model, [t or "" for t in texts])
    names = np.array(model.languages, object)[p.argmax(axis=1)]
    return np.where(letters, names, "und"), np.where(letters, p.max(axis=1), 0.0)


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, lang_pred, score of every row from its text alone; ``und`` with score 0 for null and letterless texts."""
    sent = _sent(docs, model)

    def rows(batches):
        for batch in batches:
            names, scores = _said(sent, batch["text"].tolist())
            yield batch[["doc_id"]].assign(lang_pred=names, score=scores)

    return null_ids(with_ids(docs, "doc_id", "text").mapInPandas(rows, "doc_id long, lang_pred string, score double"), "doc_id")


def identify(docs: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE) -> DataFrame:
    """doc_id, held_out, lang_pred, score: trains on the labelled part of ``docs`` and predicts every row.

    Null doc_ids count as not held out; repeated rows get equal predictions; very long texts are read whole; without labelled
    texts all are ``und``; an empty table gives no rows; other columns are left out."""
    out = predict(docs, train(docs, per_language))
    return out.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def in_known_language(docs: DataFrame, least: float = 0.5, **options) -> DataFrame:
    """Rows whose text has a predicted language with at least this probability; the columns stay as they are.

    Every row is judged by its own text where it is read, so rows of one doc_id, or of none, never decide for each other.
    Null, empty and letterless texts go; repeated rows stay or go together; an empty table gives no rows."""
    sent = _sent(docs, train(docs, **options))

    def known(texts: list[str | None]) -> np.ndarray:
        names, scores = _said(sent, texts)
        return (names != "und") & (scores >= least)

    return keep_rows(docs, "text", known)


def query(spark, sf_dir):
    return identify(table(spark, sf_dir, "documents"))
