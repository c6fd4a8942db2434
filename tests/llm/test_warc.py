import gzip
import io
import json
import zlib

import duckdb
import pytest
from comparison import difference

from basketry.llm import warc
from basketry.llm.common import file_at

PAGES = [
    (1, "http://a/1", "<p>x</p>", "z"), (2, "http://a/2", "<p>x</p>", "z"), (3, None, None, "z"), (4, "u\r\nInjected: y", "", "z"),
    (5, "http://a/5", "é" * 50_000, "z"), (5, "http://a/5", "é" * 50_000, "z"), (6, "http://a/6", "\r\n\r\nWARC/1.1\r\n\r\n", "z"), (None, "v", "lonely", "z"),
]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame(PAGES, "page_id long, url string, html string, digest string")


def test_round_trip_matches_sql(spark, pages, small):
    for df in (pages, spark.read.parquet(f"{small}/pages.parquet"), pages.filter("page_id = 99")):
        con = duckdb.connect()
        con.register("pages", df.select("page_id", "url", "html").toArrow())
        found = warc.read(warc.normalise(warc.write_monolithic(df))).drop("url")
        assert difference(found, con, warc.read_sql()) is None


def test_small_payloads_are_always_responses(pages):
    found = warc.read(warc.normalise(warc.write_monolithic(pages, min_bytes=5))).collect()
    by_id = {r.page_id: r for r in found}
    assert by_id[3].record_type == by_id[4].record_type == "response"
    assert by_id[1].record_type == "revisit" and by_id[1].refers_to == 2
    assert by_id[4].url == "u%0D%0AInjected: y"


def test_every_record_is_a_member_of_its_own(pages):
    before = warc.write_monolithic(pages)
    after = warc.normalise(before)
    assert sum(r.records for r in after.collect()) == len(PAGES)
    old = before.first().path
    files, inner = file_at(old)
    whole = zlib.decompressobj(31)
    whole.decompress(files.open_input_file(inner).read())
    assert whole.eof and not whole.unused_data  # one stream
    for row in after.collect():
        files, inner = file_at(row.path)
        data, end = files.open_input_file(inner).read(), 0
        for line in files.open_input_file(inner + ".idx").read().splitlines():
            place = json.loads(line)
            assert place["offset"] == end
            end += place["length"]
            record = gzip.decompress(data[place["offset"] : end])
            fields, block = warc.parse(record)
            assert fields["warc-record-id"] == place["id"] and len(block) == int(fields["content-length"])
        assert end == len(data)


def test_records_from_streams_of_any_shape():
    made = [warc.record(i, "u", b"p" * i, "D", None, False) for i in range(30)]
    one = gzip.compress(b"".join(made))
    many = b"".join(map(gzip.compress, made))
    for data in (one, many):
        for chunk in (1, 7, 1 << 20):
            assert list(warc.records(io.BytesIO(data), chunk)) == made
    with pytest.raises(ValueError):
        list(warc.records(io.BytesIO(gzip.compress(made[3][:-5]))))
