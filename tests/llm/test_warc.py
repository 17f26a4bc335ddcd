import base64
import hashlib

from strataudit.llm import warc


def test_roundtrip(spark):
    big = "x" * 200_000 + "é"
    rows = [(1, "u\r\nX: y", "a"), (2, None, "a"), (3, "u", None), (4, "u", ""), (None, "u", "a"), (5, "u", big), (6, "v", big), (7, "u", "b"), (7, "u", "b")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS key", "2 AS payload")
    chunks = [r.asDict() for r in warc.read(warc.write(pages, archive_bytes=1000), chunk=1 << 16).collect()]
    by_page: dict = {}
    for c in sorted(chunks, key=lambda c: c["chunk_no"]):
        by_page.setdefault((c["page_id"], c["record_id"]), []).append(c)
    for parts in by_page.values():
        data, last = b"".join(dict.fromkeys((p["chunk_no"], p["data"]) for p in parts) and [p["data"] for p in {p["chunk_no"]: p for p in parts}.values()]), parts[-1]
        assert last["last"] and last["bytes_so_far"] == len(data)
        if last["record_type"] == "response":
            assert last["digest_so_far"] == last["stated_digest"] == base64.b32encode(hashlib.sha1(data).digest()).decode()
    kinds = {(c["page_id"], c["record_type"], c["refers_to"]) for c in chunks}
    assert kinds == {("1", "response", None), ("2", "revisit", "1"), ("3", "response", None), ("4", "revisit", "3"), (None, "revisit", "1"),
                     ("5", "response", None), ("6", "revisit", "5"), ("7", "response", None)}
    assert warc.read(warc.write(pages.limit(0))).count() == 0
    assert {r.record_type for r in warc.read(warc.write(pages, least=10**6)).collect()} == {"response"}


def test_archives_are_read_side_by_side(spark):
    pages = spark.range(64).selectExpr("id AS page_id", "'u' AS url", "repeat(cast(id AS string), 3000) AS html").repartition(8)
    manifest = warc.write(pages, archive_bytes=20_000)
    read = warc.read(manifest, keep_data=False).selectExpr("spark_partition_id() AS p", "page_id").toPandas()
    assert len(read) == 64 and read.p.nunique() > 0.6 * manifest.count() > 4


def test_a_long_payload_in_chunks(spark):
    """Forty megabytes: chunks of the right sizes, with running lengths and digests."""
    pages = spark.range(1).selectExpr("id AS page_id", "'u' AS url", "repeat('0123456789abcdef', 2621440) || 'z' AS html")
    rows = warc.read(warc.write(pages), chunk=1 << 20, keep_data=False).orderBy("chunk_no").collect()
    text = b"0123456789abcdef" * 2621440 + b"z"
    assert [r.bytes_so_far for r in rows] == [*range(1 << 20, len(text), 1 << 20), len(text)] and [r.last for r in rows] == [False] * 40 + [True]
    for r in (rows[0], rows[20], rows[-1]):
        assert r.digest_so_far == base64.b32encode(hashlib.sha1(text[:r.bytes_so_far]).digest()).decode()
