"""Collocations: phrases of two to four words counted through bidirectional FM-indexes of shards, whose counts are summed."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .biindex import BiIndex, Patterns
from .io import discard, stored, table
from .words import encoded, mix

LEAST, LONGEST, TOP = 30, 4, 2000
#: A phrase goes if a longer candidate around it has this share (percent) of its occurrences.
COVERED = 80
#: Words of one shard's index, at most one text more.
SHARD_WORDS = 2_000_000
#: Bits of a filter of frequent words or pairs at most (16 MB); a fuller filter lets more through and changes no result.
FILTER_BITS = 1 << 27
#: Frequent words that get a number at most (8 bytes each go to all tasks); with more, phrases are counted by their text.
NUMBERED_WORDS = 1 << 24
#: Phrases by text that a task holds at most while it sums those of its shards.
HELD_PHRASES = 1 << 19
#: The final ranks of a language are made from the best of this many parts of it.
RANK_PARTS = 16
_STEP = np.uint64(0x9E3779B97F4A7C15)
_PIECE = b".,;:!?\n\x0b\x0c\r"
#: A-Z to a-z, tabs to spaces, ends of pieces to line feeds.
_PLAIN = bytes(10 if c in _PIECE else 32 if c == 9 else c + 32 if 65 <= c <= 90 else c for c in range(256))


def _plain(text: str | None) -> bytes:
    """Lower-cased, words parted by spaces, and a line feed as a word wherever a piece ends."""
    return encoded(text).translate(_PLAIN).replace(b"\n", b" \n ")


class _Filter:
    """A Bloom filter over 64-bit keys; it lets all of them pass, and few others."""

    def __init__(self, words: np.ndarray):
        self.words, self.mask = words, np.uint64(len(words) * 64 - 1)

    def has(self, keys: np.ndarray) -> np.ndarray:
        out = np.ones(len(keys), bool)
        for shift in (np.uint64(0), np.uint64(13)):
            at = (keys >> shift) & self.mask
            out &= (self.words[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) == 1
        return out


class _Numbers:
    """Numbers of words, from 1: the places of their keys, which are all different, in order; 0 for others."""

    def __init__(self, keys: np.ndarray):
        self.keys = np.sort(keys)

    def of(self, keys: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.keys, keys)
        known = at < len(self.keys)
        known[known] = self.keys[at[known]] == keys[known]
        return np.where(known, at + 1, 0)

    def has(self, keys: np.ndarray) -> np.ndarray:
        return self.of(keys) > 0


def _numbers(words: DataFrame, least: int) -> _Numbers | None:
    """Numbers of the frequent words of (lang, word, n); none if they are too many, or if one shares its key with another word."""
    if words.where(F.col("n") >= least).count() > NUMBERED_WORDS:
        return None
    keys = words.select(_key().alias("key"), "n").groupBy("key").agg(F.count(F.lit(1)).alias("words"), F.max("n").alias("n"))
    found = keys.where(F.col("n") >= least).select(F.when(F.col("words") == 1, F.col("key")).alias("key")).toArrow()["key"]
    return None if found.null_count else _Numbers(found.to_numpy().view(np.uint64))


def _key():
    """Column of the words' keys, as ``_word_key``."""
    return F.xxhash64(F.concat("lang", F.lit("\0"), "word"))


def _filter(keys: DataFrame) -> _Filter:
    """Filter of the ``key`` column of a stored table: built by the executors, at most FILTER_BITS bits reach the driver."""
    bits = min(FILTER_BITS, max(1 << 16, 1 << (16 * keys.count()).bit_length()))
    at = F.explode(F.array(*[F.shiftrightunsigned("key", s).bitwiseAND(F.lit(bits - 1)) for s in (0, 13)]))
    cells = keys.select(at.alias("at")).groupBy(F.shiftright("at", 6).cast("int").alias("cell")).agg(F.expr("bit_or(shiftleft(1L, cast(at & 63 as int)))").alias("bits"))
    found = cells.toArrow()
    words = np.zeros(bits // 64, np.int64)
    words[found["cell"].to_numpy()] = found["bits"].to_numpy()
    return _Filter(words.view(np.uint64))


def _shards(batches, size: int) -> Iterator[list[tuple]]:
    """Texts of a task in shards of about ``size`` words: for each language its name, its different words, and all words by their
    numbers from 1 on, 0 where a piece ends, -1 for nothing between two spaces."""
    texts, held = defaultdict(list), 0
    for batch in batches:
        for lang, text in zip(batch["lang"].to_pylist(), batch["text"].to_pylist()):
            texts[lang].append(plain := _plain(text))
            held += plain.count(b" ") + 1
            if held >= size:
                yield [(one, *_flow(texts.pop(one))) for one in list(texts)]
                held = 0
    if texts:
        yield [(one, *_flow(texts.pop(one))) for one in list(texts)]


def _flow(texts: list[bytes]) -> tuple:
    """Different words, and the number of every word."""
    import pyarrow as pa
    import pyarrow.compute as pc

    found = pc.split_pattern(pa.array([b" \n ".join(texts)], pa.large_binary()), b" ").values.dictionary_encode()
    end, nothing = (found.dictionary.index(pa.scalar(x, pa.large_binary())).as_py() for x in (b"\n", b""))
    word = np.ones(len(found.dictionary), bool)
    word[[x for x in (end, nothing) if x >= 0]] = False
    number = np.where(word, np.cumsum(word), -1)
    if end >= 0:
        number[end] = 0
    return found.dictionary.filter(pa.array(word)).cast(pa.binary()), number[found.indices.to_numpy()]


def _word_counts(size: int):
    def rows(batches) -> Iterator:
        import pyarrow as pa

        for shard in _shards(batches, size):
            for lang, words, flow in shard:
                n = np.bincount(flow[flow > 0], minlength=len(words) + 1)[1:]
                yield pa.record_batch([pa.array([lang] * len(words), pa.string()), words.cast(pa.string()), pa.array(n)], ["lang", "word", "n"])

    return rows


def _word_key(lang: str, word: bytes) -> int:
    """As Spark's xxhash64 of the language, a NUL and the word."""
    return int(_word_keys(lang, [word])[0])


def _word_keys(lang: str, words: list[bytes]) -> np.ndarray:
    front, key = lang.encode() + b"\0", xxhash.xxh64_intdigest
    return np.array([key(front + x, 42) for x in words], np.uint64)


def _indexes(size: int, frequent):
    """A row for each shard: languages, words and their keys by symbol, their counts, and the index over frequent words; other words end a piece."""

    def rows(batches) -> Iterator:
        import pyarrow as pa

        known = frequent.value
        for shard in _shards(batches, size):
            langs, words, keys, flows = [], [], [], [np.zeros(1, np.int64)]
            for lang, found, flow in shard:
                key = _word_keys(lang, found.to_pylist())
                kept = np.flatnonzero(known.has(key))
                symbol = np.zeros(len(key) + 2, np.int64)
                symbol[kept + 1] = len(langs) + np.arange(1, len(kept) + 1)
                flows += [symbol[flow[flow >= 0]], np.zeros(1, np.int64)]
                langs += [lang] * len(kept)
                words.append(found.take(pa.array(kept)))
                keys.append(key[kept])
            text = np.concatenate(flows)
            text = text[np.concatenate([[True], (text[1:] != 0) | (text[:-1] != 0)])]  # one separator between pieces
            if len(text) < 3:
                continue
            index = BiIndex.of(text, len(langs) + 1)
            yield pa.record_batch(
                [pa.array([langs], pa.list_(pa.string())), pa.ListArray.from_arrays(pa.array([0, len(langs)], pa.int32()), pa.concat_arrays(words))]
                + [pa.array([x], pa.binary()) for x in (np.concatenate(keys).tobytes(), index.counts.tobytes(), index.to_bytes())],
                ["langs", "words", "keys", "counts", "data"],
            )

    return rows


def _opened(batches) -> Iterator[tuple[BiIndex, object, object, np.ndarray]]:
    """Stored indexes with the languages and words of their symbols (if they are among the columns) and the words' keys."""
    for batch in batches:
        named = "words" in batch.schema.names
        for i in range(batch.num_rows):
            langs, words = (batch[x][i].values for x in ("langs", "words")) if named else (None, None)
            keys = np.concatenate([np.zeros(1, np.uint64), np.frombuffer(batch["keys"][i].as_py(), np.uint64)])
            counts = np.frombuffer(batch["counts"][i].as_py(), np.int64)
            yield BiIndex.from_bytes(batch["data"][i].as_py(), counts), langs, words, keys


def _keys(keys: np.ndarray, symbols: np.ndarray) -> np.ndarray:
    """40-bit keys of phrases. They only filter: phrases of equal key are counted together, so none is lost."""
    out = keys[symbols[:, 0]]
    with np.errstate(over="ignore"):
        for k in range(1, symbols.shape[1]):
            out = mix(out * _STEP + keys[symbols[:, k]])
    return out >> np.uint64(24)


def _kept(found: Patterns, keys: np.ndarray, known: list[_Filter], front: bool) -> Patterns:
    """Patterns whose first words (or last), as many as each filter is for, pass it."""
    for n, one in enumerate(known, 2):
        if n <= found.symbols.shape[1] and len(found.count):
            part = found.symbols[:, :n] if front else found.symbols[:, -n:]
            found = found.where(np.flatnonzero(one.has(_keys(keys, part))))
    return found


def _grown(index: BiIndex, keys: np.ndarray, known: list[_Filter], longest: int) -> Iterator[Patterns]:
    """Phrases of each length from 2: pairs by extending words to the left, longer ones by turns to the left and to the right, as long as
    the parts on that side pass the filters."""
    for block in index.words().blocks():
        wave = _kept(index.left(block), keys, known, True)
        for length in range(2, longest + 1):
            if len(wave.count):
                yield wave
            if length < longest:
                parts = [_kept(index.left(p), keys, known, True) if length % 2 == 0 else _kept(index.right(p), keys, known, False) for p in wave.blocks()]
                if not parts:
                    break
                wave = Patterns(*[np.concatenate(x) for x in zip(*parts)])


def _hashed(known, length: int):
    """(key, n) of all phrases of this length whose shorter parts pass the filters."""

    def rows(batches) -> Iterator:
        import pyarrow as pa

        for index, _, _, keys in _opened(batches):
            for found in _grown(index, keys, [x.value for x in known], length):
                if found.symbols.shape[1] == length:
                    yield pa.record_batch([pa.array(_keys(keys, found.symbols).view(np.int64)), pa.array(found.count)], ["key", "n"])

    return rows


def _numbered(numbers, known, longest: int):
    """(first, n) of pairs, or (first, second, n) of longer phrases whose pairs pass the filter: the numbers of their words, two in a long, 0 after
    the last."""

    def rows(batches) -> Iterator:
        import pyarrow as pa

        for index, _, _, keys in _opened(batches):
            number = numbers.value.of(keys)
            for found in _grown(index, keys, [x.value for x in known], longest):
                if found.symbols.shape[1] > 2 or longest == 2:
                    at = number[found.symbols]
                    longs = [(at[:, 0] << 32) | at[:, 1]]
                    if longest > 2:
                        longs.append((at[:, 2] << 32) | at[:, 3] if at.shape[1] > 3 else at[:, 2] << 32)
                    yield pa.record_batch([*map(pa.array, longs), pa.array(found.count)], [*["first", "second"][: len(longs)], "n"])

    return rows


def _pair_keys(numbers):
    """(key) of pairs of numbers, for a filter."""

    def rows(batches) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            first = batch["first"].to_numpy()
            yield pa.record_batch([pa.array(_keys(numbers.value.keys, np.column_stack([first >> 32, first & 0xFFFFFFFF]) - 1).view(np.int64))], ["key"])

    return rows


def _words_by_number(numbers):
    """(number, lang, word) of (key, lang, word)."""

    def rows(batches) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            number = numbers.value.of(batch["key"].to_numpy().view(np.uint64))
            yield pa.record_batch([pa.array(number), batch["lang"], batch["word"]], ["number", "lang", "word"])

    return rows


def _summed(batches: Iterator, most: int) -> Iterator:
    """Batches of (lang, phrase, n) in which a phrase's counts are summed as far as ``most`` held rows allow."""
    import pyarrow as pa

    held, size = [], 0
    for batch in batches:
        held.append(pa.Table.from_batches([batch]))
        size += batch.num_rows
        if size >= 2 * most:
            held = [_sums(held)]
            size = held[0].num_rows
            if size >= most:
                yield from held[0].to_batches(1 << 16)
                held, size = [], 0
    if held:
        yield from _sums(held).to_batches(1 << 16)


def _sums(tables: list):
    import pyarrow as pa

    found = pa.concat_tables(tables).group_by(["lang", "phrase"], use_threads=False).aggregate([("n", "sum")])
    return found.select(["lang", "phrase", "n_sum"]).rename_columns(["lang", "phrase", "n"]).combine_chunks()


def _named(known, longest: int):
    """(lang, phrase, n) of the phrases whose parts pass the filters, summed over a task's shards."""

    def found(batches) -> Iterator:
        import pyarrow as pa
        import pyarrow.compute as pc

        for index, langs, words, keys in _opened(batches):
            for found in _grown(index, keys, [x.value for x in known], longest):
                parts = [words.take(pa.array(found.symbols[:, k] - 1)).cast(pa.string()) for k in range(found.symbols.shape[1])]
                yield pa.record_batch([langs.take(pa.array(found.symbols[:, 0] - 1)), pc.binary_join_element_wise(*parts, " "), pa.array(found.count)], ["lang", "phrase", "n"])

    def rows(batches) -> Iterator:
        return _summed(found(batches), HELD_PHRASES)

    return rows


def counted_phrases(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, shard_words: int = SHARD_WORDS) -> tuple[DataFrame, DataFrame]:
    """(lang, word, n) of all words, and (lang, phrase, n) of the phrases of 2 to ``longest`` words with n >= ``least``; both stored.

    1. Words are counted in shards and summed. The frequent ones are numbered by their 64-bit keys, which go to all tasks, after a look
       that no other word has such a key; so numbers stand for texts without error.
    2. Every shard gets an FM-index over its frequent words, in both directions, which is stored.
    3. All pairs are enumerated by extending words to the left, and summed by their numbers; a filter of the frequent ones goes out.
    4. Longer phrases whose pairs pass are enumerated to the left and to the right in turn, and summed in the same way.
    5. Frequent phrases get the texts of their words.

    Where keys of words clash or frequent words are too many, phrases are summed by text instead (``_by_text``).
    """
    if longest > LONGEST:
        raise ValueError(f"phrases have at most {LONGEST} words")
    context = docs.sparkSession.sparkContext
    named = docs.select(F.coalesce(docs["lang"], F.lit("und")).alias("lang"), F.coalesce(docs["text"], F.lit("")).alias("text"))
    words = stored(named.mapInArrow(_word_counts(shard_words), "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n")), "phrases-words")
    numbers = _numbers(words, least)
    known = context.broadcast(_filter(words.where(F.col("n") >= least).select(_key().alias("key"))) if numbers is None else numbers)
    shards = named.mapInArrow(_indexes(shard_words, known), "langs array<string>, words array<binary>, keys binary, counts binary, data binary")
    shards = stored(shards if numbers is None else shards.drop("langs", "words"), "phrases-indexes")
    found = _by_text(shards, least, longest) if numbers is None else _by_number(shards, words, known, least, longest)
    discard(shards)
    return words, found


def _by_number(shards: DataFrame, words: DataFrame, numbers, least: int, longest: int) -> DataFrame:
    """(lang, phrase, n) of the frequent phrases, summed by the numbers of their words; stored."""

    def frequent(known: list, longest: int, *by: str) -> DataFrame:
        rows = shards.mapInArrow(_numbered(numbers, known, longest), "".join(f"{x} long, " for x in by) + "n long")
        rows = rows.repartition(*by).groupBy(*by).agg(F.sum("n").alias("n")).where(F.col("n") >= least)
        return stored(rows, "phrases-numbers")

    made = [frequent([], 2, "first")]
    every = made[0].select("first", F.lit(0).cast("long").alias("second"), "n")
    if longest > 2:
        pairs = shards.sparkSession.sparkContext.broadcast(_filter(keys := stored(made[0].select("first").mapInArrow(_pair_keys(numbers), "key long"), "phrases-keys")))
        made += [keys, frequent([pairs], longest, "first", "second")]
        every = every.union(made[-1])
    texts = stored(words.where(F.col("n") >= least).select(_key().alias("key"), "lang", "word").mapInArrow(_words_by_number(numbers), "number long, lang string, word string"), "phrases-texts")
    low = F.lit(0xFFFFFFFF).cast("long")
    parts = F.array(F.shiftright("first", 32), F.col("first").bitwiseAND(low), F.shiftright("second", 32), F.col("second").bitwiseAND(low))
    parts = every.select("first", "second", "n", F.posexplode(parts).alias("at", "number")).where(F.col("number") > 0).join(texts.hint("merge"), "number")
    phrase = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "word"))), lambda x: x["word"]), " ")
    found = stored(parts.groupBy("first", "second", "n").agg(F.first("lang").alias("lang"), phrase.alias("phrase")).select("lang", "phrase", "n"), "phrases-found")
    for done in (*made, texts):
        discard(done)
    return found


def _by_text(shards: DataFrame, least: int, longest: int) -> DataFrame:
    """(lang, phrase, n) of the frequent phrases, summed by their text (in a task first); stored. Pairs and triples are summed by a hash
    before, and a filter of the frequent hashes goes out, so only phrases whose parts pass get a text; neither can change a count."""
    filters, made = [], []
    for length in range(2, min(longest, 3) + 1):
        keys = shards.mapInArrow(_hashed(list(filters), length), "key long, n long").repartition("key").groupBy("key").agg(F.sum("n").alias("n"))
        keys = stored(keys.where(F.col("n") >= least).select("key"), "phrases-keys")
        filters.append(shards.sparkSession.sparkContext.broadcast(_filter(keys)))
        made.append(keys)
    found = shards.mapInArrow(_named(filters, longest), "lang string, phrase string, n long").repartition("lang", "phrase").groupBy("lang", "phrase").agg(F.sum("n").alias("n"))
    found = stored(found.where(F.col("n") >= least), "phrases-found")
    for done in made:
        discard(done)
    return found


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, covered: int = COVERED, top: int = TOP, shard_words: int = SHARD_WORDS) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the ``top`` collocations of every language.

    a, l and r are the occurrences of the phrase and of its parts at the cut with the lowest floor(2000000 * a / (l + r)), n the words
    of the language. Phrases inside a longer candidate with ``covered`` percent of their occurrences are left out.

    Null texts are empty; a null language is ``und`` and counts with texts of that language. Texts without a phrase give no rows, very
    long texts are read whole (a shard holds at least one), repeated rows count each, other columns are left out, an empty table gives no
    rows. Ties in score and count go by the phrase's bytes, so ranks are certain.
    """
    words, found = counted_phrases(docs, least, longest, shard_words)
    parts = stored(words.where(F.col("n") >= least).select("lang", F.col("word").alias("part"), F.col("n").alias("f")).union(found), "phrases-parts")
    w, size = F.split("phrase", " "), F.size(F.split("phrase", " "))
    inner = F.flatten(F.transform(F.sequence(F.lit(2), size - 1), lambda m: F.transform(F.sequence(F.lit(1), size - m + 1), lambda i: F.array_join(F.slice(w, i, m), " "))))
    inside = found.where(size > 2).select("lang", F.explode(F.array_distinct(inner)).alias("phrase"), F.col("n").alias("longer"))
    inside = stored(inside.groupBy("lang", "phrase").agg(F.max("longer").alias("longer")), "phrases-inside")
    left = found.withColumnRenamed("n", "a").join(inside.hint("merge"), ["lang", "phrase"], "left")
    left = left.where(F.col("longer").isNull() | (F.col("longer") * 100 < F.col("a") * covered)).drop("longer")
    cuts = left.select("lang", "phrase", "a", F.explode(F.sequence(F.lit(1), size - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", F.array_join(F.slice(w, F.lit(1), F.col("k")), " ").alias("head"), F.array_join(F.slice(w, F.col("k") + 1, size), " ").alias("tail"))
    cuts = cuts.join(parts.select("lang", F.col("part").alias("head"), F.col("f").alias("l")).hint("merge"), ["lang", "head"])
    cuts = cuts.join(parts.select("lang", F.col("part").alias("tail"), F.col("f").alias("r")).hint("merge"), ["lang", "tail"])
    score = F.expr("cast(cast(2000000 as decimal(20,0)) * cast(a as decimal(18,0)) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0))) as long)")
    best = cuts.withColumn("score", score).groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    scored = best.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score", F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS)).alias("part"))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    first = scored.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).where(F.col("rank") <= top)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    ranked = stored(ranked.select("lang", "rank", "phrase", "a", "l", "r", "score"), "phrases-ranked")
    totals = stored(words.groupBy("lang").agg(F.sum("n").alias("n")), "phrases-totals")
    for done in (words, found, parts, inside):
        discard(done)
    return ranked.join(totals.hint("merge"), "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def query(spark, sf_dir):
    return collocations(table(spark, sf_dir, "documents"))


ORACLE = r"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
p AS (SELECT lang, regexp_extract_all(unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') AS ws FROM d),
g AS (SELECT lang, m, array_to_string(ws[i:i + m - 1], ' ') AS ph FROM (SELECT lang, ws, m, unnest(range(1, len(ws) - m + 2)) AS i FROM p, (SELECT unnest([1, 2, 3, 4]) AS m))),
f AS (SELECT lang, m, ph, count(*) AS n FROM g GROUP BY ALL),
t AS (SELECT lang, sum(n)::BIGINT AS n FROM f WHERE m = 1 GROUP BY lang),
c AS (SELECT lang, m, ph, n AS a, string_split(ph, ' ') AS w FROM f WHERE m > 1 AND n >= 30),
s AS (SELECT lang, a, array_to_string(w[i:i + k - 1], ' ') AS ph FROM (SELECT lang, a, w, k, unnest(range(1, m - k + 2)) AS i FROM c, (SELECT unnest([2, 3]) AS k) WHERE k < m)),
x AS (SELECT lang, ph, max(a) AS longer FROM s GROUP BY lang, ph),
k AS (SELECT c.lang, c.ph, c.a, c.w, unnest(range(1, c.m)) AS k FROM c LEFT JOIN x USING (lang, ph) WHERE x.longer IS NULL OR 100 * x.longer < 80 * c.a),
l AS (SELECT k.lang, k.ph, k.a, k.k, l.n AS l, r.n AS r, (2000000::HUGEINT * k.a) // (l.n + r.n) AS score
      FROM k JOIN f l ON l.lang = k.lang AND l.ph = array_to_string(k.w[1:k.k], ' ') JOIN f r ON r.lang = k.lang AND r.ph = array_to_string(k.w[k.k + 1:], ' ')),
b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, ph ORDER BY score, k) AS o FROM l) WHERE o = 1),
o AS (SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, ph) AS rank, ph AS phrase, a, l, r, score FROM b)
SELECT o.lang, o.rank, o.phrase, o.a, o.l, o.r, t.n, o.score::BIGINT AS score FROM o JOIN t USING (lang) WHERE o.rank <= 2000
"""
