import gzip
import random
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from winnow.sources import files, warc


def record(kind, id, url, block):
    head = (
        f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Record-ID: {id}\r\nWARC-Target-URI: {url}\r\n"
        f"WARC-Date: 2024-10-09T21:13:35Z\r\nContent-Length: {len(block)}\r\n\r\n"
    )
    return head.encode() + block + b"\r\n\r\n"


def http(body, *headers):
    return "\r\n".join(["HTTP/1.1 200 OK", *headers, "", ""]).encode() + body


def test_read_warc(spark, tmp_path):
    tricky = "<p>é\r\n\r\nWARC/1.0\r\nWARC-Type: response\r\n</p>".encode()
    chunked = b"4\r\n<p>a\r\n5;x=y\r\nb</p>\r\n0\r\n\r\n"
    records = [
        record("warcinfo", "<urn:info>", "", b"software: x"),
        record("request", "<urn:req>", "http://a/", b"GET / HTTP/1.1\r\n\r\n"),
        record("response", "<urn:1>", "http://a/1", http(tricky)),
        record("response", "<urn:2>", "http://a/2", http(chunked, "Transfer-Encoding: chunked")),
        record("response", "<urn:3>", "http://a/3", http(gzip.compress(b"zipped"), "Content-Encoding: gzip")),
        record("response", "<urn:4>", "http://a/4", http(b"plain", "Content-Encoding: gzip")),
        record("response", "<urn:5>", "http://a/5", http(b"bad \xff\xfe bytes")),
    ]
    members = tmp_path / "members.warc.gz"
    members.write_bytes(b"".join(gzip.compress(r) for r in records[:4]))
    single = tmp_path / "single.warc.gz"
    single.write_bytes(gzip.compress(b"".join(records[4:])))
    df = warc.read_warc(spark, [str(members), single.as_uri()])
    rows = {r.id: r for r in df.collect()}
    assert {k: r.html for k, r in rows.items()} == {
        "<urn:1>": tricky.decode(), "<urn:2>": "<p>ab</p>", "<urn:3>": "zipped",
        "<urn:4>": "plain", "<urn:5>": "bad  bytes",
    }
    assert rows["<urn:1>"].url == "http://a/1"
    assert rows["<urn:1>"].file_path == str(members)
    assert df.rdd.getNumPartitions() == 2
    seconds = df.select(F.unix_seconds("date")).distinct().collect()
    assert seconds[0][0] == int(datetime(2024, 10, 9, 21, 13, 35, tzinfo=timezone.utc).timestamp())
    assert warc.read_warc(spark, [str(members)], limit=1).count() == 1


def read_in_ranges(path, split, limit=-1):
    reader = warc.ArchiveReader({"path": str(path), "splitBytes": str(split), "limit": str(limit)})
    parts = [[r for b in reader.read(p) for r in b.to_pylist()] for p in reader.partitions()]
    return [r["id"] for part in parts for r in part], parts


def many(draw, count, start=0):
    bodies = [draw.randbytes(draw.randint(0, 3000)).hex().encode() for _ in range(count)]
    return [record("response", f"<urn:{start + i}>", "http://a/", http(b)) for i, b in enumerate(bodies)]


@pytest.mark.parametrize("split", [1, 700, 5000, 40_000, 10**9, 0])
def test_ranges_of_an_archive_have_every_record_once(tmp_path, split):
    draw = random.Random(split)
    rows = many(draw, 60)
    path = tmp_path / "a.warc.gz"
    path.write_bytes(b"".join(gzip.compress(r) for r in rows) + b"\0" * 2000)
    found, parts = read_in_ranges(path, split)
    assert found == [f"<urn:{i}>" for i in range(60)]
    assert (len(parts) > 1) == (0 < split < 10**9)
    single = tmp_path / "b.warc.gz"
    single.write_bytes(gzip.compress(b"".join(rows)))
    assert read_in_ranges(single, split)[0] == found
    assert all(len(p) <= 2 for p in read_in_ranges(path, split, limit=2)[1])


@pytest.mark.parametrize("level", [0, 6])
def test_an_archive_within_a_record(tmp_path, level):
    draw = random.Random(level)
    inner = b"".join(gzip.compress(r) for r in many(draw, 20, start=1000))
    rows = many(draw, 10) + [record("response", "<urn:10>", "http://a/", http(inner))] + many(draw, 10, 11)
    path = tmp_path / "a.warc.gz"
    path.write_bytes(b"".join(gzip.compress(r, level) for r in rows))
    for split in range(len(inner) + 1000, len(inner) + 40_000, 3000):
        assert read_in_ranges(path, split)[0] == [f"<urn:{i}>" for i in range(21)]
    for split in (3000, 8000):  # shorter than the record: whole, or refused
        try:
            assert read_in_ranges(path, split)[0] == [f"<urn:{i}>" for i in range(21)]
        except ValueError:
            pass


def test_an_archive_that_is_cut_off(tmp_path):
    path = tmp_path / "a.warc.gz"
    path.write_bytes(b"".join(gzip.compress(r) for r in many(random.Random(1), 30))[:-40])
    for split in (0, 2000, 10**9):
        with pytest.raises(EOFError):
            read_in_ranges(path, split)


def test_read_warc_in_ranges(spark, tmp_path):
    path = tmp_path / "a.warc.gz"
    path.write_bytes(b"".join(gzip.compress(r) for r in many(random.Random(2), 40)))
    df = warc.read_warc(spark, [str(path)], split_bytes=10_000)
    assert df.rdd.getNumPartitions() > 3
    assert sorted(r.id for r in df.select("id").collect()) == sorted(f"<urn:{i}>" for i in range(40))
    assert warc.read_warc(spark, [path.as_uri()], limit=5, split_bytes=10_000).count() == 5


def test_cut_off_archive_fails(spark, tmp_path):
    path = tmp_path / "cut.warc"
    path.write_bytes(record("response", "<urn:1>", "http://a", http(b"0123456789"))[:-8])
    with pytest.raises(Exception, match="cut off"):
        warc.read_warc(spark, [str(path)]).collect()


def test_jsonl_round_trip(spark, tmp_path):
    df = spark.createDataFrame(
        [("1", "a\nb", {"k": "v"}), ("2", None, None)],
        "id string, text string, metadata map<string,string>",
    )
    path = str(tmp_path / "out")
    files.write_jsonl(df, path)
    back = files.read_jsonl(spark, path)
    assert all(f.endswith(".json.gz") for f in back.inputFiles())
    assert {(r.id, r.text) for r in back.collect()} == {("1", "a\nb"), ("2", None)}


def test_report_scores_is_idempotent(spark, tmp_path):
    path = str(tmp_path)
    rows = spark.createDataFrame([(1, 10, 0.5)], "uid int, task_id int, score double")
    for batch_id in (0, 0, 1):
        files.report_scores(rows, path, batch_id)
    assert spark.read.parquet(f"{path}/reports").count() == 2
    assert sorted(r.step for r in spark.read.parquet(f"{path}/log").collect()) == [0, 1]


def test_publish(spark, tmp_path):
    shards = [spark.range(3).toDF("id"), spark.range(3, 5).withColumn("extra", F.lit("x"))]
    path = files.publish_dataset(shards, str(tmp_path), "name", datetime(2024, 1, 2, 3))
    assert path.endswith("name_2024_01_02_03")
    published = spark.read.parquet(path)
    assert published.count() == 5
    assert {r.split for r in published.collect()} == {"train"}


def test_archive_batches(tmp_path):
    path = tmp_path / "a.warc.gz"
    page = b"x" * 1_000_000
    record = b"WARC/1.0\r\nWARC-Type: response\r\nContent-Length: %d\r\n\r\n%s\r\n" % (len(page), page)
    path.write_bytes(gzip.compress(record, 1) * 12)
    batches = list(warc.ArchiveReader({"paths": str(path)}).read(warc.ArchiveRange(str(path), 0, None)))
    assert sum(b.num_rows for b in batches) == 12
    assert max(b.nbytes for b in batches) < 5_000_000
