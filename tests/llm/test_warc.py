import gzip
import hashlib

import pytest
from framelake.llm import warc
from pyspark.sql import functions as F

SCHEMA = "page_id long, url string, html string, lo int, hash int, bad int"


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(i, f"http://h{i % 3}.org/{i}", f"<p>é {i}</p>\r\n" * (i % 5), 1, 1, 1) for i in range(700)]
    rows += [(None, None, None, 1, 1, 1), (1000, None, "", 1, 1, 1), (5, "http://h2.org/5", "", 1, 1, 1), (5, "http://h2.org/5", "", 1, 1, 1)]
    return spark.createDataFrame(rows, SCHEMA)


def statuses(out):
    return sorted((r["page_id"] is None, r["page_id"] or 0, r["status"]) for r in out.collect())


def test_equal_replicas_are_whole(pages):
    out = warc.audit_replicas(pages, pages.repartition(9))
    assert out.count() == pages.count() and {r["status"] for r in out.collect()} == {"ok"}


def test_faults_are_located(pages, monkeypatch):
    for records in (16, 2, 10_000):  # trees of several depths, and of one leaf
        monkeypatch.setattr(warc, "LEAF_RECORDS", records)
        out = warc.audit_replicas(pages, warc.damaged_replica(pages))
        want = []
        for r in pages.collect():
            i = r["page_id"]
            one = i is not None
            status = "missing" if one and i % 193 == 7 else "corrupt" if one and i % 97 == 5 else "ok"
            want.append((i is None, i or 0, status))
            if one and i % 211 == 9 and i % 193 != 7:
                want.append((False, i, "extra"))
        assert statuses(out) == sorted(want)


def test_records_meet_in_bad_ranges_only(pages, monkeypatch):
    monkeypatch.setattr(warc, "LEAF_RECORDS", 2)
    seen = []
    kept = warc._compared
    monkeypatch.setattr(warc, "_compared", lambda a, b, bad: seen.append(bad.count()) or kept(a, b, bad))
    assert {r["status"] for r in warc.audit_replicas(pages, pages).collect()} == {"ok"} and not seen
    one = pages.withColumn("html", F.when(F.col("page_id") == 77, "x").otherwise(F.col("html")))
    assert statuses(warc.audit_replicas(pages, one).where("status <> 'ok'")) == [(False, 77, "corrupt")] and seen == [1]


def test_copies_of_one_name(spark):
    rows = lambda *texts: spark.createDataFrame([(1, "u", t, 1, 1, 1) for t in texts] + [(2, "v", "w", 1, 1, 1)], SCHEMA)
    count = lambda a, b: sorted(r["status"] for r in warc.audit_replicas(rows(*a), rows(*b)).where("page_id = 1").collect())
    assert count("aab", "aab") == ["ok"] * 3
    assert count("aab", "ab") == ["missing", "ok", "ok"]
    assert count("aab", "abbc") == ["corrupt", "extra", "ok", "ok"]
    assert count("aaa", "bb") == ["corrupt", "corrupt", "missing"]
    assert count("", "ab") == ["extra", "extra"]


def test_a_record_without_id_is_known_by_its_content(spark):
    rows = lambda *texts: spark.createDataFrame([(None, None, t, 1, 1, 1) for t in texts], SCHEMA)
    out = warc.audit_replicas(rows("a", "a", "b", None), rows("a", "c", "b", ""))
    assert sorted(r["status"] for r in out.collect()) == ["extra", "extra", "missing", "missing", "ok", "ok"]


def test_offsets_and_digests(pages, monkeypatch):
    monkeypatch.setattr(warc, "LEAF_RECORDS", 4)
    monkeypatch.setattr(warc, "FILE_LEVELS", 1)
    rows = warc.audit_replicas(pages, pages).orderBy("file_id", "record_no").collect()
    at, number = {}, {}
    for r in rows:
        assert r["offset"] == at.get(r["file_id"], 0) and r["record_no"] == number.get(r["file_id"], 0)
        at[r["file_id"]], number[r["file_id"]] = r["offset"] + r["n_bytes"], r["record_no"] + 1
    assert len(at) > 10
    record = pages.where("page_id = 6").select(warc.warc_record().alias("record")).first()["record"]
    assert hashlib.sha256(record.encode()).hexdigest() == next(r["digest"] for r in rows if r["page_id"] == 6)
    assert "\r\nWARC-Date: " in record and f"sha256:{hashlib.sha256(b'<p>' + 'é 6</p>'.encode() + bytes([13, 10])).hexdigest()}" in record


def test_round_trip_through_files(spark, pages, tmp_path):
    warc.write_warc(pages, str(tmp_path / "w"), 3)
    back = warc.read_warc(spark, str(tmp_path / "w"))
    plain = pages.select("page_id", "url", "html")
    assert sorted(map(str, back.select("page_id", "url", "html").collect())) == sorted(map(str, plain.collect()))
    assert back.agg(F.max("offset")).first()[0] > 0 and back.where("error is not null").count() == 0


def test_broken_files_give_rejects(spark, pages, tmp_path):
    whole = "\r\n\r\n".join(r["record"] for r in pages.where("page_id < 3").orderBy("page_id").select(warc.warc_record().alias("record")).collect()).encode()
    for name, content in (("cut", whole[:-3]), ("head", whole[:40]), ("junk", b"not a WARC file"), ("none", b""), ("large", whole * 9)):
        (tmp_path / f"{name}.txt").write_bytes(content)
    out = warc.read_warc(spark, str(tmp_path), most_bytes=len(whole) * 5).collect()
    assert sorted(r["error"] for r in out if r["error"]) == ["bad_header", "bad_header", "too_large", "truncated"]
    assert [r["page_id"] for r in out if not r["error"]] == [0, 1]


def foreign(k, body, kind="response", version="1.0"):
    head = f"WARC/{version}\r\nWARC-Type: {kind}\r\nwarc-record-id: <urn:uuid:{k:032x}>\r\nWARC-Target-URI: http://h/{k}\r\nContent-Type: application/http\r\nContent-Length: {len(body)}\r\n\r\n"
    return head.encode() + body + b"\r\n\r\n"


def test_records_of_other_writers(spark, pages, tmp_path):
    bodies = [b"HTTP/1.1 200 OK\r\n\r\n" + bytes(range(256)) * (k % 5) + b"\r\n\r\n" * (k % 3) for k in range(300)]
    kinds = ["response", "request", "metadata"]
    records = [foreign(k, b, kinds[k % 3], f"1.{k % 2}") for k, b in enumerate(bodies)]
    (tmp_path / "sub").mkdir()
    (tmp_path / "a.warc").write_bytes(b"".join(records[:100]))
    (tmp_path / "sub" / "b.warc.gz").write_bytes(b"".join(gzip.compress(r) for r in records[100:200]))
    (tmp_path / "c.warc.gz").write_bytes(gzip.compress(b"".join(records[200:])))
    (tmp_path / "none.warc").write_bytes(b"")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        out = warc.read_records(spark, str(tmp_path))
        assert out.rdd.getNumPartitions() > 10
        rows = {r["record_id"]: r for r in out.collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(rows) == 300 and out.count() == 300 and not any(r["error"] for r in rows.values())
    for k, body in enumerate(bodies):
        r = rows[f"<urn:uuid:{k:032x}>"]
        assert bytes(r["block"]) == body and (r["type"], r["url"], r["digest"]) == (kinds[k % 3], f"http://h/{k}", None)


def test_broken_records_of_other_writers(spark, tmp_path):
    (tmp_path / "cut.warc").write_bytes(foreign(1, b"whole") + foreign(2, b"x" * 50)[:-30])
    (tmp_path / "junk.warc").write_bytes(b"no WARC file\r\n\r\n")
    (tmp_path / "quoted.warc").write_bytes(foreign(3, b"before\r\n\r\nWARC/1.quoted") + foreign(4, b"after"))
    out = warc.read_records(spark, str(tmp_path)).collect()
    assert sorted((str(r["error"]), bytes(r["block"])[:5]) for r in out) == [("None", b"after"), ("None", b"whole"), ("bad_header", b"no WA"), ("bad_header", b"quote"), ("cut", b"befor"), ("cut", b"xxxxx")]


def test_written_files_are_read_as_records(spark, pages, tmp_path):
    warc.write_warc(pages, str(tmp_path / "w"), 3)
    out = warc.read_records(spark, str(tmp_path / "w")).where("type = 'resource' and error is null")
    assert sorted(bytes(r["block"]).decode() for r in out.collect()) == sorted(r["html"] or "" for r in pages.collect())


def test_tree_root_changes_with_any_record(pages):
    def root(df):
        return [r["hash"] for r in warc.merkle_levels(warc.fixity_index(df, 2), 2)[0].collect()]

    a = root(pages)
    assert len(a) == 1 and a == root(pages.repartition(3))
    assert a != root(pages.withColumn("html", F.when(F.col("page_id") == 77, "x").otherwise(F.col("html"))))
    assert a != root(pages.union(pages.where("page_id = 3")))


def test_empty_tables(spark, pages):
    none = spark.createDataFrame([], SCHEMA)
    assert warc.audit_replicas(none, none).count() == 0
    assert {r["status"] for r in warc.audit_replicas(none, pages).collect()} == {"extra"}
    assert {r["status"] for r in warc.audit_replicas(pages, none).collect()} == {"missing"}
