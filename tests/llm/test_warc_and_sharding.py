import gzip
import hashlib
import io
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from ladle.llm import sharding, warc

from .data import awkward, docs

BIG = "<html>" + "é" * 600 + "</html>"
PAGES = [(1, BIG), (2, BIG), (3, None), (4, ""), (5, "small"), (6, "small"), (7, "WARC/1.1\r\n\r\n" + "x\r\n" * 900), (8, BIG), (8, BIG), (None, BIG), (9, "y" * 2_000_000)]


def pages(spark, rows=PAGES):
    return spark.createDataFrame([(i, f"http://h/{i}\n", h, "x") for i, h in rows], "page_id long, url string, html string, payload string")


def expected(rows):
    best = defaultdict(lambda: -(10**9))
    for i, h in rows:
        if i is not None:
            best[h] = max(best[h], i)
    result = []
    for i, h in rows:
        data = (h or "").encode()
        revisit = len(data) >= 1000 and i != best[h]
        result.append((i, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", best[h] if revisit else None))
    return sorted(map(str, result))


def test_pages_come_back(spark, folder):
    assert sorted(str(tuple(r)) for r in warc.archived_pages(pages(spark)).collect()) == expected(PAGES)
    table = spark.read.parquet(f"{folder}/pages.parquet")
    rows = [(r.page_id, r.html) for r in table.collect()]
    assert sorted(str(tuple(r)) for r in warc.archived_pages(table).collect()) == expected(rows)
    assert warc.archived_pages(pages(spark, [])).count() == 0


@pytest.mark.parametrize("compression", ["gzip", "none"])
def test_filters_and_payloads(spark, tmp_path, compression):
    folder = str(tmp_path / compression)
    warc.write_archive(warc.page_records(pages(spark)).repartition(3), folder, compression=compression)
    table = warc.read_archive(spark, folder)
    assert table.count() == len(PAGES) and table.filter("record_type = 'revisit'").count() == 3
    assert table.filter("record_id IN ('<urn:page:5>', '<urn:page:7>')").count() == 2
    one = table.filter(F.col("target_uri").startswith("http://h/7")).collect()
    assert [bytes(r.payload).decode() for r in one] == [PAGES[6][1]]
    assert "\n" not in one[0].target_uri
    bare = warc.read_archive(spark, folder, payload="false")
    assert bare.filter("payload IS NOT NULL").count() == 0 and bare.agg(F.sum("http_length")).first()[0] > 2_000_000
    warc.write_archive(warc.page_records(pages(spark, PAGES[:1])), folder, compression=compression)
    assert table.count() == len(PAGES) + 1  # appended
    assert not list((tmp_path / compression).glob("_tmp*"))


class Counting(io.BytesIO):
    taken = 0

    def read(self, n=-1):
        self.taken += n
        return super().read(n)


def test_unwanted_blocks_are_not_read():
    row = {"record_id": "<urn:page:1>", "record_type": "response", "target_uri": None, "warc_date": None, "payload_digest": None, "refers_to": None, "http_length": 9}
    data = warc.record_bytes(row, b"p" * 100_000) * 3
    stream = Counting(data)
    assert list(warc.records(stream, lambda c: False, True)) == [] and stream.taken == 0
    found = list(warc.records(Counting(data), lambda c: True, True))
    assert [r[-1] for r in found] == [b"p" * 100_000] * 3
    with pytest.raises(ValueError):
        list(warc.records(Counting(data[:-50_000]), lambda c: True, True))
    with pytest.raises(ValueError):
        list(warc.records(Counting(b"GARBAGE"), lambda c: True, True))


def test_records_are_members_of_their_own(spark, tmp_path):
    folder = str(tmp_path / "z")
    warc.write_archive(warc.page_records(pages(spark)).coalesce(1), folder)
    (path,) = (tmp_path / "z").glob("*.warc.gz")
    data, members = path.read_bytes(), 0
    assert gzip.decompress(data).startswith(b"WARC/1.1\r\nWARC-Record-ID: ")
    while data:
        d = zlib.decompressobj(31)
        assert d.decompress(data).startswith(b"WARC/1.1")
        data, members = d.unused_data, members + 1
    assert members == len(PAGES)


def test_shards(spark, folder):
    for table, texts in (
        (spark.read.parquet(f"{folder}/documents.parquet"), None),
        (docs(spark, awkward()), awkward()),
    ):
        texts = texts or [(r.doc_id, r.text) for r in table.collect()]
        rows = sharding.shard_documents(table).collect()
        plain = sorted(str((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode()))) for i, t in texts)
        assert sorted(str((r.doc_id, r["size"], r.text_crc32)) for r in rows) == plain
        slots = defaultdict(list)
        for r in rows:
            slots[r.shard].append(r.slot)
            assert 0 <= r.shard < 16 and r.grown_shard in (r.shard, 16) and r.law == "key"
        assert all(sorted(s) == list(range(len(s))) for s in slots.values())
        assert len({(r.doc_id, r.shard, r.grown_shard) for r in rows}) == len({r.doc_id for r in rows})
    assert sharding.shard_documents(docs(spark, [])).count() == 0


def test_weights_and_removed_shards(spark):
    ids = spark.range(20_000)
    at = lambda w: {r.id: r.s for r in ids.select("id", sharding.rendezvous(F.col("id"), w).alias("s")).collect()}
    even, heavy, less = at([1, 1, 1, 1]), at([1, 1, 1, 3]), at([1, 1, 1, 0])
    share = Counter(heavy.values())
    assert abs(share[3] / 20_000 - 0.5) < 0.02 and abs(share[0] / 20_000 - 1 / 6) < 0.02
    assert all(heavy[i] in (even[i], 3) for i in even)  # a weight that grows only draws keys
    assert all(less[i] == even[i] for i in even if even[i] != 3) and 3 not in less.values()
    with pytest.raises(ValueError):
        sharding.rendezvous(F.col("id"), [0, 0])
