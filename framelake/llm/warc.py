"""WARC records and Merkle fixity audits of replicas (DataFrame functions, but for parsing WARC files)."""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .io import discard, join_small, stored, table

#: Records of a leaf range at most, on average. Every level above has a hexadecimal digit less.
LEAF_RECORDS = 16
#: A WARC file holds the ranges below a node this many levels above the leaves: 4096 records at most, on average.
FILE_LEVELS = 2
#: Pages carry no time of capture; a WARC record must have a date.
DATE = "1970-01-01T00:00:00Z"
#: WARC files above this size are reported, not read.
MOST_BYTES = 512 << 20
CRLF = "\r\n"


def _text(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def warc_record(date: str = DATE) -> Column:
    """The record of a page as text, without its closing empty lines. A null url has no target line, a null html is marked."""
    url = F.when(F.col("url").isNotNull(), F.concat(F.lit("WARC-Target-URI: "), F.regexp_replace("url", r"[\r\n]", ""), F.lit(CRLF)))
    none = F.when(F.col("html").isNull(), F.lit(f"X-Body: none{CRLF}"))
    return F.concat(
        F.lit(f"WARC/1.0{CRLF}WARC-Type: resource{CRLF}WARC-Date: {date}{CRLF}WARC-Record-ID: <urn:page:"), _text("page_id"), F.lit(f">{CRLF}"),
        F.coalesce(url, F.lit("")), F.coalesce(none, F.lit("")), F.lit(f"WARC-Block-Digest: sha256:"), F.sha2(_text("html"), 256),
        F.lit(f"{CRLF}Content-Type: text/html{CRLF}Content-Length: "), F.octet_length(_text("html")).cast("string"), F.lit(CRLF + CRLF), _text("html"),
    )


def tree_depth(records: int) -> int:
    """Levels below the root, so that a leaf range has LEAF_RECORDS records at most on average."""
    depth = 0
    while LEAF_RECORDS * 16**depth < records:
        depth += 1
    return depth


def _placed(pages: DataFrame, depth: int) -> DataFrame:
    """page_id, url, node (the leaf range: digits of a digest of the record's name), file_id, record.

    A record is named by page_id and url, so that a changed one stays in its range; without a page_id its content names it.
    Nothing depends on the host, so a hot host makes no large file.
    """
    record = pages.select("page_id", "url", warc_record().alias("record"))
    name = F.concat_ws("|", _text("page_id"), _text("url"), F.when(F.col("page_id").isNull(), F.sha2("record", 256)))
    file = F.substring("node", 1, max(0, depth - FILE_LEVELS))
    return record.withColumn("node", F.substring(F.md5(name), 1, depth)).withColumn("file_id", F.when(F.length(file) > 0, F.conv(file, 16, 10).cast("long")).otherwise(F.lit(0)))


def write_warc(pages: DataFrame, path: str, depth: int) -> None:
    """Writes WARC files under path/file_id=N, each record followed by two empty lines. Repeated rows are records of their own;
    an empty table writes none. The files keep the text writer's names."""
    out = _placed(pages, depth).repartition("file_id").sortWithinPartitions("file_id", "node", "page_id", "url")
    out.select("file_id", F.col("record").alias("value")).write.partitionBy("file_id").option("lineSep", CRLF * 2).text(path)


def _parsed(content: bytes) -> Iterator[tuple]:
    """(page_id, url, html, offset, error) of every record; after a broken one the rest of the file is a reject."""
    at = 0
    while at < len(content):
        end = content.find(b"\r\n\r\n", at)
        head = content[at:end].decode(errors="replace") if end >= 0 else ""
        size, page = re.search(r"^Content-Length: (\d+)\r?$", head, re.M), re.search(r"<urn:page:(-?\d*)>", head)
        if not (head.startswith("WARC/1.") and size and page):
            yield None, None, None, at, "bad_header"
            return
        body = content[end + 4 : end + 4 + int(size[1])]
        if len(body) < int(size[1]):
            yield int(page[1]) if page[1] else None, None, None, at, "truncated"
            return
        url = re.search(r"^WARC-Target-URI: (.*?)\r?$", head, re.M)
        none = re.search(r"^X-Body: none\r?$", head, re.M)
        yield int(page[1]) if page[1] else None, url and url[1], None if none else body.decode(errors="replace"), at, None
        at = end + 4 + int(size[1]) + 4


def read_warc(spark, path: str, most_bytes: int = MOST_BYTES) -> DataFrame:
    """page_id, url, html, offset, error of every record under ``path``.

    A task holds one file at a time. What cannot be read comes back as a row with an error: bad_header or truncated (with the offset
    where the file breaks), too_large (the file is not read). Null url and html come back as null, empty ones as empty.
    """

    def rows(batches) -> Iterator:
        import pyarrow as pa

        names = ["page_id", "url", "html", "offset", "error"]
        types = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()]
        schema = pa.schema(list(zip(names, types)))
        for batch in batches:
            for content in batch.column("content"):
                out = []
                for row in _parsed(content.as_py()):
                    out.append(row)
                    if len(out) == 1000:
                        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), types)], schema=schema)
                        out = []
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), types)], schema=schema)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.txt*").load(path)
    schema = "page_id long, url string, html string, offset long, error string"
    large = files.where(F.col("length") > most_bytes).selectExpr("cast(null as long) page_id", "cast(null as string) url", "cast(null as string) html", "0L offset", "'too_large' error")
    return files.where(F.col("length") <= most_bytes).select("content").mapInArrow(rows, schema).union(large)


#: What stands between two records; what follows it is the version's last digit.
BETWEEN = "\r\n\r\nWARC/1."
FIELDS = {"record_id": "WARC-Record-ID", "type": "WARC-Type", "date": "WARC-Date", "url": "WARC-Target-URI", "content_type": "Content-Type", "digest": "WARC-Block-Digest"}


def read_records(spark, path) -> DataFrame:
    """Records of any writer: record_id, type, date, url, content_type, digest, block (binary), error, file.

    Plain files are split at ``BETWEEN``, so a file of any size is read by many tasks; compressed ones (.gz, a member a record or not) are streamed by
    a task each. A task holds a record at a time. Missing fields are null, the same record twice is two rows, a file without a byte gives none. A piece that
    is no record is a row with error bad_header and the piece as its block; a block shorter than its stated length has error cut: the file ends there, or the
    block holds the separator itself, and then its rest is a bad_header row or a record of its own.
    """
    pieces = spark.read.option("lineSep", BETWEEN).option("recursiveFileLookup", "true").text(path).select("value", F.col("_metadata.file_path").alias("file"))
    # only a file's first piece still has its start
    first = F.when(F.col("value").startswith("WARC/1."), F.lit(7)).otherwise(F.lit(0))
    head = F.substring_index("value", CRLF + CRLF, 1)
    own = pieces.where(F.octet_length("value") > 0).select("file", F.col("value").cast("binary").alias("raw"), head.alias("head"), first.alias("first"))
    found = {name: F.nullif(F.regexp_extract("head", rf"(?im)^{field}[ \t]*:[ \t]*(.*?)[ \t\r]*$", 1), F.lit("")) for name, field in FIELDS.items()}
    size = F.regexp_extract("head", r"(?im)^Content-Length[ \t]*:[ \t]*(\d{1,9})[ \t\r]*$", 1).try_cast("int")
    begin = F.octet_length("head") + len(CRLF + CRLF)
    known = F.substring("head", F.col("first") + 1, 3).rlike(r"\A[0-9]\r\n") & (begin <= F.octet_length("raw")) & size.isNotNull()
    own = own.withColumns(found).withColumn("block", F.when(known, F.substring("raw", begin + 1, size)).otherwise(F.col("raw")))
    error = F.when(~F.coalesce(known, F.lit(False)), "bad_header").when(F.octet_length("block") < size, "cut")
    return own.select(*[F.when(known, F.col(name)).alias(name) for name in FIELDS], "block", error.alias("error"), "file")


def fixity_index(pages: DataFrame, depth: int) -> DataFrame:
    """The stored index of a replica: file_id, node, page_id, url, digest, n_bytes (with the closing lines), copies, cell, record_no, offset.

    Equal records are one row with their number of copies. Records lie in order of node, cell (digits of the digest) and name;
    numbers and offsets are running sums within a cell, over the sums of the file's cells before, so that a name with very many
    records is spread over its cells.
    """
    placed = _placed(pages, depth)
    columns = ["file_id", "node", "page_id", "url", "digest", "n_bytes"]
    entries = placed.select("file_id", "node", "page_id", "url", F.sha2("record", 256).alias("digest"), (F.octet_length("record") + 4).cast("long").alias("n_bytes"))
    entries = stored(entries.groupBy(*columns).agg(F.count(F.lit(1)).alias("copies")).withColumn("cell", F.substring("digest", 1, 2)), "warc-entries")
    sums = entries.groupBy("file_id", "node", "cell").agg(F.sum("copies").alias("n"), F.sum(F.col("copies") * F.col("n_bytes")).alias("b"))
    before = Window.partitionBy("file_id").orderBy("node", "cell").rowsBetween(Window.unboundedPreceding, -1)
    bases = stored(sums.select("file_id", "node", "cell", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"{c}0") for c in ("n", "b")]), "warc-cells")
    within = Window.partitionBy("file_id", "node", "cell").orderBy("page_id", "url", "digest").rowsBetween(Window.unboundedPreceding, -1)
    first = {"record_no": F.coalesce(F.sum("copies").over(within), F.lit(0)), "offset": F.coalesce(F.sum(F.col("copies") * F.col("n_bytes")).over(within), F.lit(0))}
    out = entries.withColumns(first).join(bases.hint("merge"), ["file_id", "node", "cell"])
    out = stored(out.select(*columns, "copies", (F.col("record_no") + F.col("n0")).alias("record_no"), (F.col("offset") + F.col("b0")).alias("offset")), "warc-index")
    discard(entries)
    discard(bases)
    return out


def merkle_levels(index: DataFrame, depth: int) -> list[DataFrame]:
    """The stored tree of a replica, from the root to the leaf ranges: node, n_bytes, hash.

    A leaf range hashes its records: their number, bytes, and the sums of two halves of their digests, so that a range of any
    size is one partial aggregation. A node hashes its children in order with the bytes that each covers, which fixes their offsets.
    """
    half = lambda i: F.conv(F.substring(F.sha2(F.concat_ws("|", "page_id", "url", "digest", "n_bytes"), 256), i, 15), 16, 10).cast("decimal(38,0)") * F.col("copies")
    size = F.sum(F.col("copies") * F.col("n_bytes")).cast("long").alias("n_bytes")
    sums = [F.sum(half(i).cast("decimal(38,0)")).cast("string") for i in (1, 16)]
    leaf = F.sha2(F.concat_ws("|", F.sum("copies").cast("string"), *sums), 256)
    levels = [stored(index.groupBy("node").agg(size, leaf.alias("hash")), f"warc-level{depth}")]
    for level in range(depth - 1, -1, -1):  # a node has sixteen children at most
        child = F.array_sort(F.collect_list(F.struct("node", F.col("n_bytes").cast("string").alias("b"), "hash")))
        made = levels[0].groupBy(F.substring("node", 1, level).alias("up")).agg(F.sum("n_bytes").alias("n_bytes"), child.alias("c"))
        hashed = F.sha2(F.array_join(F.transform("c", lambda x: F.concat_ws(":", x["node"], x["b"], x["hash"])), "|"), 256)
        levels.insert(0, stored(made.select(F.col("up").alias("node"), "n_bytes", hashed.alias("hash")), f"warc-level{level}"))
    return levels


def differing_ranges(ours: list[DataFrame], theirs: list[DataFrame]) -> DataFrame | None:
    """Leaf ranges whose hashes differ, found from the roots down; None if the roots agree. Only the children of differing nodes are read."""
    bad = None
    for level, (mine, other) in enumerate(zip(ours, theirs)):
        if bad is not None:
            parents = bad.select(F.col("node").alias("up"))
            mine, other = [join_small(x.withColumn("up", F.substring("node", 1, level - 1)), _like(parents, bad), "up", "left_semi") for x in (mine, other)]
        both = mine.select("node", "hash").join(other.select("node", F.col("hash").alias("other")).hint("merge"), "node", "full")
        found = stored(both.where(~F.col("hash").eqNullSafe(F.col("other"))).select("node"), "warc-bad")
        if bad is not None:
            discard(bad)
        if not found.take(1):
            discard(found)
            return None
        bad = found
    return bad


def _like(df: DataFrame, source: DataFrame) -> DataFrame:
    df.stored_path = source.stored_path
    return df


def _compared(ours: DataFrame, theirs: DataFrame, bad: DataFrame) -> DataFrame:
    """Faults within the differing ranges, for records of the first copy (with file_id, record_no) and extra ones of the second.

    Under one name the copies that both have agree; of the others, in order of digest, as many as the second has are corrupt, the
    rest is missing, and what the second has beyond them is extra. Columns: those of the index, n (copies), status.
    """
    mine, other = [join_small(x, bad, "node", "left_semi") for x in (ours, theirs)]
    same = ["node", "page_id", "url", "digest"]
    columns = {c: F.first(c, ignorenulls=True) for c in ("file_id", "record_no", "offset", "n_bytes")}
    tagged = mine.select(*same, "file_id", "record_no", "offset", "n_bytes", F.col("copies").alias("a"), F.lit(0).cast("long").alias("b"))
    tagged = tagged.union(other.select(*same, "file_id", *[F.lit(None).cast("long")] * 2, "n_bytes", F.lit(0).cast("long"), F.col("copies")))
    both = tagged.groupBy(*same).agg(*[v.alias(k) for k, v in columns.items()], F.sum("a").alias("a"), F.sum("b").alias("b"))
    left, more = F.greatest(F.col("a") - F.col("b"), F.lit(0)), F.greatest(F.col("b") - F.col("a"), F.lit(0))
    name = Window.partitionBy("node", "page_id", "url", F.when(F.col("page_id").isNull(), F.col("digest")))
    before = name.orderBy("digest").rowsBetween(Window.unboundedPreceding, -1)
    both = stored(both.withColumns({"left": left, "more": more}).where("a <> b"), "warc-faults")
    both = both.withColumns({"left0": F.coalesce(F.sum("left").over(before), F.lit(0)), "more0": F.coalesce(F.sum("more").over(before), F.lit(0)), "lefts": F.sum("left").over(name), "mores": F.sum("more").over(name)})
    corrupt = F.greatest(F.lit(0), F.least(F.col("left"), F.col("mores") - F.col("left0")))
    extra = F.greatest(F.lit(0), F.least(F.col("more"), F.col("more0") + F.col("more") - F.col("lefts")))
    out = both.withColumns({"corrupt": corrupt, "extra": extra})
    return out.select("page_id", "url", "file_id", "record_no", "offset", "n_bytes", "digest", "corrupt", (F.col("left") - F.col("corrupt")).alias("missing"), "extra")


def audit_replicas(first: DataFrame, second: DataFrame) -> DataFrame:
    """Compares two copies of a page table (page_id, url, html) through Merkle trees.

    Each copy is indexed and hashed into a tree of its own, which is stored. The roots are compared, then only the children of
    nodes that differ; records of the two copies meet only within the ranges found bad, and not at all if the roots agree.

    Returns every record of the first copy: page_id, url, file_id, record_no, offset, n_bytes, digest, status (ok, corrupt, missing),
    and those that only the second has (status extra, record_no and offset -1, digest null). Of repeated rows the first ones are
    corrupt, then missing, then whole. Nulls are values of their own; a record without page_id is known by its content, so a changed one
    is missing and extra. Two empty tables give no rows; other columns are left out.
    """
    depth = tree_depth(first.count())
    ours, theirs = [fixity_index(x, depth) for x in (first, second)]
    trees = [merkle_levels(x, depth) for x in (ours, theirs)]
    bad = differing_ranges(*trees)
    for level in [*trees[0], *trees[1]]:
        discard(level)
    columns = ["page_id", "url", "file_id", "record_no", "offset", "n_bytes", "digest"]
    if bad is None:
        discard(theirs)
        return _expanded(ours.withColumns({"corrupt": F.lit(0).cast("long"), "missing": F.lit(0).cast("long")})).select(*columns, "status")
    faults = stored(_compared(ours, theirs, bad), "warc-found")
    discard(theirs)
    located = _like(faults.where("record_no is not null").select("file_id", "record_no", "corrupt", "missing"), faults)
    whole = join_small(ours, located, ["file_id", "record_no"], "left").fillna(0, ["corrupt", "missing"])
    extra = faults.where("extra > 0").withColumn("k", F.explode(F.sequence(F.lit(1).cast("long"), "extra")))
    extra = extra.select("page_id", "url", "file_id", F.lit(-1).cast("long").alias("record_no"), F.lit(-1).cast("long").alias("offset"), "n_bytes", F.lit(None).cast("string").alias("digest"), F.lit("extra").alias("status"))
    return _expanded(whole).select(*columns, "status").union(extra)


def _expanded(entries: DataFrame) -> DataFrame:
    """A row for every copy, with its own number, offset and status."""
    k = F.col("k")
    out = entries.withColumn("k", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)))
    status = F.when(k < F.col("corrupt"), "corrupt").when(k < F.col("corrupt") + F.col("missing"), "missing").otherwise("ok")
    return out.withColumns({"record_no": F.col("record_no") + k, "offset": F.col("offset") + k * F.col("n_bytes"), "status": status})


def damaged_replica(pages: DataFrame) -> DataFrame:
    """A copy with planted faults that depend on page_id alone: 1 in 97 altered, 1 in 193 lost, 1 in 211 twice."""
    html = F.when(F.col("page_id") % 97 == 5, F.concat(_text("html"), F.lit("\x00"))).otherwise(F.col("html"))
    copies = F.when(F.col("page_id") % 193 == 7, 0).when(F.col("page_id") % 211 == 9, 2).otherwise(1)
    return pages.withColumn("html", html).withColumn("_n", F.explode(F.array_repeat(F.lit(0), copies))).drop("_n")


def query(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return audit_replicas(pages, damaged_replica(pages))


#: Both copies as tables of records, compared by name.
ORACLE = r"""
WITH pages_a AS (SELECT page_id, url, html FROM pages),
pages_b AS (
  SELECT page_id, url, CASE WHEN page_id % 97 = 5 THEN coalesce(html, '') || chr(0) ELSE html END AS html
  FROM (SELECT *, unnest(CASE WHEN page_id % 193 = 7 THEN [] WHEN page_id % 211 = 9 THEN [1, 2] ELSE [1] END) AS n FROM pages)),
n AS (SELECT count(*) AS n FROM pages),
depth AS (SELECT CASE WHEN n <= 16 THEN 0 WHEN n <= 256 THEN 1 WHEN n <= 4096 THEN 2 WHEN n <= 65536 THEN 3 WHEN n <= 1048576 THEN 4 ELSE 5 END AS d FROM n),
records AS (
  SELECT who, page_id, url, 'WARC/1.0' || chr(13) || chr(10) || 'WARC-Type: resource' || chr(13) || chr(10) || 'WARC-Date: 1970-01-01T00:00:00Z' || chr(13) || chr(10)
      || 'WARC-Record-ID: <urn:page:' || coalesce(page_id::VARCHAR, '') || '>' || chr(13) || chr(10)
      || CASE WHEN url IS NULL THEN '' ELSE 'WARC-Target-URI: ' || url || chr(13) || chr(10) END || CASE WHEN html IS NULL THEN 'X-Body: none' || chr(13) || chr(10) ELSE '' END
      || 'WARC-Block-Digest: sha256:' || sha256(coalesce(html, '')) || chr(13) || chr(10) || 'Content-Type: text/html' || chr(13) || chr(10)
      || 'Content-Length: ' || strlen(coalesce(html, '')) || chr(13) || chr(10) || chr(13) || chr(10) || coalesce(html, '') AS record
  FROM (SELECT 'a' AS who, * FROM pages_a UNION ALL SELECT 'b', * FROM pages_b)),
entries AS (
  SELECT who, page_id, url, substr(md5(coalesce(page_id::VARCHAR, '') || '|' || coalesce(url, '')), 1, (SELECT d FROM depth)) AS node, sha256(record) AS digest, (strlen(record) + 4)::BIGINT AS n_bytes FROM records),
filed AS (
  SELECT *, CASE WHEN (SELECT d FROM depth) <= 2 THEN 0 ELSE ('0x' || substr(node, 1, (SELECT d FROM depth) - 2))::BIGINT END AS file_id,
    row_number() OVER (PARTITION BY who, page_id, url ORDER BY digest) AS copy FROM entries),
a AS (
  SELECT *, row_number() OVER w - 1 AS record_no, coalesce(sum(n_bytes) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS "offset" FROM filed WHERE who = 'a'
  WINDOW w AS (PARTITION BY file_id ORDER BY node, substr(digest, 1, 2), page_id, url, digest)),
b AS (SELECT * FROM filed WHERE who = 'b')
SELECT coalesce(a.page_id, b.page_id) AS page_id, coalesce(a.url, b.url) AS url, coalesce(a.file_id, b.file_id) AS file_id, coalesce(record_no, -1) AS record_no, coalesce("offset", -1) AS "offset",
  coalesce(a.n_bytes, b.n_bytes) AS n_bytes, a.digest, CASE WHEN a.digest IS NULL THEN 'extra' WHEN b.digest IS NULL THEN 'missing' WHEN a.digest <> b.digest THEN 'corrupt' ELSE 'ok' END AS status
FROM a FULL JOIN b ON a.page_id = b.page_id AND a.url IS NOT DISTINCT FROM b.url AND a.copy = b.copy
"""
