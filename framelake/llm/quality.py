"""Quality rules as a ledger of failure bits (DataFrame functions only)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .io import table

WORDS = r"[^\x20\x09-\x0D]+"

#: Rules in bit order: name, and the SQL condition under which a document fails. Append only; bits keep their meaning.
RULES: tuple[tuple[str, str], ...] = (
    ("few_words", "n_words < 50"),
    ("repeated_windows", "100 * n_repeat_words > 50 * n_words"),
    ("long_words", "word_chars > 25 * n_words"),
    ("short_words", "word_chars < 2 * n_words"),
    ("symbols", "5 * n_symbols > n_words"),
    ("repeated_lines", "2 * n_dup_lines > n_lines"),
    ("many_words", "n_words > 1000000"),
    ("few_letters", "2 * n_letters < word_chars"),
)
BIT = {name: 1 << i for i, (name, _) in enumerate(RULES)}
#: Versioned policies: the rules that reject a document.
POLICIES: dict[str, tuple[str, ...]] = {
    "base": ("few_words", "repeated_windows"),
    "v1": ("few_words", "repeated_windows", "long_words", "symbols", "repeated_lines"),
    "v2": ("few_words", "repeated_windows", "long_words", "short_words", "symbols", "repeated_lines", "few_letters"),
}


def policy_mask(version: str) -> int:
    return sum(BIT[name] for name in POLICIES[version])


def _pairs(words: Column) -> Column:
    """(hash of the 3 words, start) of every 3-word window."""
    starts = F.when(F.size(words) >= 3, F.sequence(F.lit(0), F.size(words) - 3)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.struct(F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)).alias("h"), i.alias("i")))


MEASURES = ("n_words", "word_chars", "n_symbols", "n_letters", "n_lines", "n_dup_lines", "n_repeat_words")


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds the measurements to every row: n_words, word_chars, n_symbols, n_letters, n_lines, n_dup_lines, n_repeat_words.

    Windows are compared by a 64-bit hash within one document: they are sorted with their starts, neighbours of equal hash are
    repeated, and the words that they cover are the sum of min(3, distance to the next repeated start). Null text has no words;
    repeated rows get equal measurements; all other columns stay, but for those named like a measurement, which it replaces.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    # the caller's columns stand apart, so that none can clash with a step's
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c not in MEASURES]).alias("_row")
    lines = F.filter(F.split(body, "\n", -1), lambda x: x.rlike(WORDS))
    out = docs.select(row, body.alias("_body"), F.regexp_extract_all(body, F.lit(f"({WORDS})"), F.lit(1)).alias("_words"), lines.alias("_lines"))
    out = out.withColumn("_pairs", F.sort_array(_pairs(F.col("_words"))))
    h = lambda k: F.get(F.col("_pairs"), k)["h"]
    again = F.filter(F.col("_pairs"), lambda x, k: F.coalesce(x["h"] == h(k - 1), F.lit(False)) | F.coalesce(x["h"] == h(k + 1), F.lit(False)))
    out = out.withColumn("_starts", F.sort_array(F.transform(again, lambda x: x["i"])))
    covered = F.aggregate(
        F.col("_starts"),
        F.struct(F.lit(-3).alias("last"), F.lit(0).alias("n")),
        lambda acc, i: F.struct(i.alias("last"), (acc["n"] + F.least(F.lit(3), i - acc["last"])).alias("n")),
        lambda acc: acc["n"],
    )
    measures = (
        F.size("_words"), F.length(F.array_join("_words", "")), F.regexp_count("_body", F.lit(r"[#*$%&|<>]")), F.length(F.regexp_replace("_body", r"[^\p{L}]+", "")),
        F.size("_lines"), F.size("_lines") - F.size(F.array_distinct("_lines")), covered,
    )
    return out.select("_row.*", *[m.cast("long").alias(n) for n, m in zip(MEASURES, measures)])


def ledger(docs: DataFrame, text: str = "text") -> DataFrame:
    """Measurements and failure bits (failures, which replaces a column of that name): every rule is evaluated once per document."""
    bits = [F.when(F.expr(condition), F.lit(1 << i)).otherwise(F.lit(0)) for i, (_, condition) in enumerate(RULES)]
    mask = bits[0]
    for b in bits[1:]:
        mask = mask.bitwiseOR(b)
    return measure(docs, text).withColumn("failures", mask.cast("long"))


def apply_policy(entries: DataFrame, version: str) -> DataFrame:
    """kept: no rule of the policy failed. Needs the ledger only, not the texts."""
    return entries.withColumn("kept", F.col("failures").bitwiseAND(F.lit(policy_mask(version))) == 0)


def ablation(entries: DataFrame, version: str) -> DataFrame:
    """For every rule of a policy: documents that fail it, that fail it alone, and that stay without it."""
    mask = policy_mask(version)
    own = F.col("failures").bitwiseAND(F.lit(mask))
    sums = [F.count_if(own == 0).alias("_kept"), F.count(F.lit(1)).alias("_rows"), F.bit_or(own).alias("_seen")]
    for name in POLICIES[version]:
        sums += [F.count_if(own.bitwiseAND(F.lit(BIT[name])) != 0).alias(f"f_{name}"), F.count_if(own == BIT[name]).alias(f"a_{name}")]
    rows = [F.struct(F.lit(n).alias("rule"), F.lit(BIT[n]).alias("bit"), F.col(f"f_{n}").alias("failed"), F.col(f"a_{n}").alias("failed_alone"), (F.col("_kept") + F.col(f"a_{n}")).alias("kept_without")) for n in POLICIES[version]]
    return entries.agg(*sums).select(F.inline(F.array(*rows)))


def query(spark, sf_dir, version: str = "v1"):
    kept = apply_policy(ledger(table(spark, sf_dir, "documents").select("doc_id", "text")), version)
    base = F.col("failures").bitwiseAND(F.lit(policy_mask("base"))) != 0
    return kept.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base.alias("base_failed"), "kept", "failures")


ORACLE = r"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS rid, coalesce(text, '') AS t FROM documents),
w AS (SELECT rid, doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
g AS (SELECT rid, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS gram
      FROM (SELECT rid, ws, unnest(range(1, len(ws) - 1)) AS i FROM w WHERE len(ws) >= 3)),
r AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, gram) AS n FROM g) WHERE n > 1),
c AS (SELECT rid, sum(least(3, coalesce(nxt - i, 3)))::BIGINT AS n
      FROM (SELECT rid, i, lead(i) OVER (PARTITION BY rid ORDER BY i) AS nxt FROM r) GROUP BY rid),
m AS (SELECT doc_id, len(ws)::BIGINT AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
             length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
             length(regexp_replace(t, '[^\p{L}]+', '', 'g'))::BIGINT AS n_letters, len(ls)::BIGINT AS n_lines,
             (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words
      FROM w LEFT JOIN c USING (rid)),
f AS (SELECT *, ((n_words < 50)::INT + 2 * (100 * n_repeat_words > 50 * n_words)::INT + 4 * (word_chars > 25 * n_words)::INT
        + 8 * (word_chars < 2 * n_words)::INT + 16 * (5 * n_symbols > n_words)::INT + 32 * (2 * n_dup_lines > n_lines)::INT
        + 64 * (n_words > 1000000)::INT + 128 * (2 * n_letters < word_chars)::INT)::BIGINT AS failures FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (failures & 3) <> 0 AS base_failed,
       (failures & 55) = 0 AS kept, failures FROM f
"""
