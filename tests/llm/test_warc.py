"""WARC round trips, any byte ranges, revisits, false magic."""

import base64
import gzip
import hashlib
import random

from pyspark.sql import functions as F

from airwave.llm import warc

SCHEMA = "page_id long, url string, html string, digest string, path string"


def pages():
    rng = random.Random(2)
    big = "".join(chr(rng.randrange(32, 0x2FF)) for _ in range(300_000))
    texts = ["same", "same", "other", None, "", "same", big, big + "x", "\r\n\r\nWARC/1.1\r\n", "é" * 500]
    rows = [(i, f"http://x/{i}" if i % 3 else None, t) for i, t in enumerate(texts)]
    rows += [(100 + i, "http://y", f"{'p' * rng.randrange(2000)}{i % 40}") for i in range(200)]
    return rows + [(None, "http://n", "same"), (2, "http://again", "same"), (5, "http://x/5", "same")]


def expected(rows, min_bytes=0):
    first = {}
    for i, _, t in rows:
        if i is not None and len((t or "").encode()) >= min_bytes:
            first[t or ""] = min(i, first.get(t or "", i))
    out = []
    for i, _, t in rows:
        data = (t or "").encode()
        least = first.get(t or "")
        revisit = i is not None and least is not None and len(data) >= min_bytes and i > least
        out.append((i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(),
                    "revisit" if revisit else "response", least if revisit else None))
    return sorted(out, key=str)


def read_rows(df):
    return sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"])
                   for r in df.collect()), key=str)


def test_round_trip_at_any_range_size(spark):
    rows = pages()
    df = spark.createDataFrame([(*r, "x", "x") for r in rows], SCHEMA).repartition(3)
    files = warc.write(df, warc.archive_folder(spark))
    for size in (977, 20_000, 1 << 30):
        assert read_rows(warc.read(files, size)) == expected(rows)
    got = {(r["page_id"], r["url"]): r["payload"] for r in warc.read(files).where(
        "record_type = 'response'").collect()}
    assert got[6, None] == rows[6][2].encode()
    assert got[8, "http://x/8"] == rows[8][2].encode()


def test_small_payloads_stay_responses(spark):
    rows = pages()
    files = warc.write(spark.createDataFrame([(*r, "x", "x") for r in rows], SCHEMA), warc.archive_folder(spark), 100)
    assert read_rows(warc.read(files, 5000)) == expected(rows, 100)


def test_empty_table(spark):
    files = warc.write(spark.createDataFrame([], SCHEMA), warc.archive_folder(spark))
    assert warc.read(files).count() == 0


class Bytes:
    def __init__(self, data):
        self.data = data

    def read_at(self, n, at):
        return self.data[at:at + n]


def test_false_magic_is_not_a_record():
    plain = gzip.compress(b"no archive member")
    one = warc.record(1, None, b"payload" + warc.MAGIC * 50, warc.digest32(b"payload" + warc.MAGIC * 50), None)
    two = warc.record(2, None, b"z" * 90_000, warc.digest32(b"z" * 90_000), None)
    data = warc.MAGIC + b"junk" + plain + one + warc.MAGIC + b"junk" + two
    found = [at for start in range(0, len(data), 61)
             for at, _ in warc.records(Bytes(data), len(data), start, min(len(data), start + 61))]
    assert found == [data.index(one), data.index(two)]


def test_headers_of_any_length_at_a_range_start():
    rng = random.Random(3)
    urls = ["http://x/" + "a" * 80_000, "http://x/" + "".join(chr(rng.randrange(33, 127)) for _ in range(200_000)),
            "http://x/" + "b" * 5_000_000, "http://x/short"]
    members = [warc.record(i, u, b"payload", warc.digest32(b"payload"), None) for i, u in enumerate(urls)]
    data, at = b"".join(members), [sum(map(len, members[:k])) for k in range(4)]
    for step in (977, 20_000, len(data)):
        found = [(place, warc.parse_head(d)[0]["warc-target-uri"]) for start in range(0, len(data), step)
                 for place, d in warc.records(Bytes(data), len(data), start, min(len(data), start + step))]
        assert found == list(zip(at, urls))


def test_records_with_long_urls_are_all_read(spark):
    rows = [(i, f"http://x/{i}/" + "u" * (200_000 if i % 2 else 5), f"t{i}") for i in range(8)]
    files = warc.write(spark.createDataFrame([(*r, "x", "x") for r in rows], SCHEMA).coalesce(1),
                       warc.archive_folder(spark))
    for size in (301, 1 << 30):
        got = warc.read(files, size)
        assert sorted((r["page_id"], r["url"]) for r in got.collect()) == [r[:2] for r in rows]
        assert {r["path"]: r["count"] for r in got.groupBy("path").count().collect()} == {
            r["path"]: r["n_records"] for r in files.collect()}


def test_every_task_may_run_again(spark):
    df = spark.createDataFrame([(i, None, f"t{i}", "x", "x") for i in range(20)], SCHEMA)
    folder = warc.archive_folder(spark)
    warc.write(df, folder)
    files = warc.write(df, folder)  # a second attempt leaves other files that the list does not name
    assert warc.read(files).select(F.count_distinct("page_id"), F.count(F.lit(1))).first() == (20, 20)
