import hashlib

import pytest
from pyspark.sql import functions as F

from adspend.llm import warc

PAGE = "<p>" + "same " * 40
ROWS = [(5, "http://a/1", PAGE), (3, "http://a/2", PAGE), (9, None, PAGE), (1, "http://b/", "short"), (2, "http://b/x", "short"),
        (4, "u\r\nX: y", None), (6, "", ""), (7, "é", "é" * 50), (8, "e", "é" * 50), (10, "x", "y" * 99), (11, "x", "y" * 99),
        (12, "big", "z\r\n\r\n" * 40000), (None, "n", PAGE), (13, "r", "r" * 200), (13, "r", "r" * 200)]


def pages(spark, rows=ROWS):
    return spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn(
        "digest", F.lit(1)).withColumn("offset", F.lit("clash")).repartition(3)


def plain(rows):
    first = {}
    for i, _, h in rows:
        if i is not None:
            first[h or ""] = min(first.get(h or "", i), i)
    out = []
    for i, _, h in rows:
        data = (h or "").encode()
        again = i is not None and len(data) >= 100 and first[h or ""] != i
        out.append((i, len(data), hashlib.sha256(data).hexdigest(), "revisit" if again else "response",
                    first[h or ""] if again else None))
    return sorted(out, key=repr)


def test_round_trip(spark, sorted_rows):
    folder, index = warc.write_warc(pages(spark))
    assert sorted_rows(warc.payloads(folder, index)) == plain(ROWS)


def test_index_first_then_selected_ranges(spark, tmp_path):
    folder, index = warc.write_warc(pages(spark), f"file://{tmp_path}/archive", file_bytes=300)
    assert {r.digest for r in index.where("page_id = 1").collect()} == {hashlib.sha256(b"short").hexdigest()}
    assert index.select("file").distinct().count() > 3
    some = index.where("page_id IN (3, 7, 12)")
    for gap in (0, 1 << 20):
        got = {r.page_id: r for r in warc.read_warc(folder, some, gap_bytes=gap).collect()}
        assert set(got) == {3, 7, 12} and bytes(got[7].payload).decode() == "é" * 50
        assert got[3].record_type == "response" and got[3].url == "http://a/2" and len(got[12].payload) == 200000
    assert warc.read_warc(folder, index.where("page_id = 99")).collect() == []


def test_archives_are_gzip_members_of_valid_records(spark, tmp_path):
    import gzip
    folder, index = warc.write_warc(pages(spark), f"{tmp_path}/archive")
    for r in index.collect():
        data = (tmp_path / "archive" / r.file).read_bytes()[r.offset: r.offset + r.length]
        raw = gzip.decompress(data)
        headers, _ = warc.parse(raw)
        body = raw.partition(b"\r\n\r\n")[2]
        assert raw.startswith(b"WARC/1.1\r\n") and len(body) == int(headers["Content-Length"]) + 4 and body.endswith(b"\r\n\r\n")
        assert headers["WARC-Payload-Digest"] == f"sha256:{r.digest}" and "X" not in headers


def test_files_no_index_row_names_do_not_count(spark, sorted_rows, tmp_path):
    folder, index = warc.write_warc(pages(spark), f"file://{tmp_path}/archive")
    (tmp_path / "archive" / "part-lost-attempt.warc.gz").write_bytes(b"left by an attempt that failed")
    assert sorted_rows(warc.payloads(folder, index)) == plain(ROWS)


def test_empty_table_and_bad_record(spark):
    folder, index = warc.write_warc(pages(spark, []))
    assert index.collect() == [] and warc.payloads(folder, index).collect() == []
    with pytest.raises(ValueError):
        warc.parse(b"HTTP/1.1 200 OK\r\n\r\n")
