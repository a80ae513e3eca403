import re
from collections import Counter

from framelake.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    seen = Counter(grams)
    covered = {i + k for i, g in enumerate(grams) if seen[g] > 1 for k in range(3)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def test_measures_equal_brute_force(messy, strange, spark):
    more = spark.createDataFrame([(900, "a\na\n \na\rb\n#|é😀 é😀 é😀 é😀", "en", "s", 0), (901, "x y z x y z w x y", "en", "s", 0)], messy.schema)
    for df in (messy.union(more), strange):
        out = quality.measure(df).collect()
        assert len(out) == df.count()
        for r in out:
            assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == brute(r["text"])


def test_policies_and_ablation(messy):
    entries = quality.ledger(messy.select("doc_id", "text")).cache()
    for version in quality.POLICIES:
        kept = {(r["doc_id"], r["failures"]): r["kept"] for r in quality.apply_policy(entries, version).collect()}
        assert all(k == (f & quality.policy_mask(version) == 0) for (_, f), k in kept.items())
        rows = entries.collect()
        mask = quality.policy_mask(version)
        for a in quality.ablation(entries, version).collect():
            rest = mask & ~a["bit"]
            assert a["failed"] == sum(bool(r["failures"] & a["bit"]) for r in rows)
            assert a["kept_without"] == sum(r["failures"] & rest == 0 for r in rows)
    base = [r for r in quality.apply_policy(entries, "base").collect()]
    assert all(r["kept"] == (r["n_words"] >= 50 and 100 * r["n_repeat_words"] <= 50 * r["n_words"]) for r in base)


def test_empty_table(empty):
    assert quality.ledger(empty).count() == 0
    assert {r["failed"] for r in quality.ablation(quality.ledger(empty), "v1").collect()} == {0}
