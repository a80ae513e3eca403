import corpus_pipeline
import pytest

from .conftest import rows_of, sentence


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    import random

    rng = random.Random(9)
    item = sentence(rng, 30)
    rows = rows_of(120) + [(500, f"{sentence(rng, 80)} {item} {sentence(rng, 30)}", "en", "a", 0), (501, "1234 !!", "en", "a", 0)]
    path = tmp_path_factory.mktemp("data")
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path)


def test_stages_one_by_one(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    names = docs.columns
    seen = []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        before = {r["doc_id"] for r in docs.collect()}
        docs = stage(spark, docs, folder)
        docs = docs.cache()
        rows = docs.collect()
        assert {r["doc_id"] for r in rows} <= before
        assert docs.columns == names or k == len(corpus_pipeline.STAGES) - 1
        seen.append({r["doc_id"] for r in rows})
    language, copies, leaks, mix, shards = seen
    assert not language & {120, 121, 122, 501} and 500 in language
    assert 2 in copies and 3 not in copies
    assert copies - leaks == {500}
    assert shards == mix


def test_run_gives_every_row_a_place(spark, folder):
    out = corpus_pipeline.run(spark, folder).collect()
    counts = [sum(r["shard"] == s for r in out) for s in range(8)]
    assert len(out) > 50 and max(counts) - min(counts) <= 1
    assert corpus_pipeline.ORACLE_SQL is None
