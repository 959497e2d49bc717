"""WARC derivatives: links, digests, and a round trip through files."""
import base64
import hashlib

from rankwise.llm import warc as w

DDL = "page_id long, url string, html string, block string"
PAGE = ("<html lang='de'><head><title>A &amp; B\n C</title></head><body><nav><a href=\"/x?a=1&amp;b\">"
        "menu</a></nav><p>Text ü one</p><p>two</p>\r\n\r\n<a class=k href='y'>z</a></body></html>")
ROWS = [(1, "http://a.example/1", PAGE, "b"), (2, "http://a.example/2\r\nX: y", "", "b"), (3, None, None, "b"),
        (None, "http://n.example/", "no markup", "b"), (1, "http://a.example/1", PAGE, "b"),
        (4, "http://a.example/long", "<p>x y</p>" * 20_000, "b")]


def digest(data):
    return "sha1:" + base64.b32encode(hashlib.sha1(data.encode()).digest()).decode()


def test_records_are_linked_and_keep_what_is_known_of_the_source(spark):
    sources = w.responses(spark.createDataFrame(ROWS, DDL)).collect()
    by_id = {r.record_id: r for r in sources}
    assert len(sources) == 6 and len(by_id) == 5
    made = w.derive(w.responses(spark.createDataFrame(ROWS, DDL))).collect()
    assert len(made) == 12
    names = {(r.record_id, r.record_type) for r in made}
    for r in made:
        s = by_id[r.refers_to]
        other = "metadata" if r.record_type == "conversion" else "conversion"
        assert (r.concurrent_to, other) in names
        assert (r.source_id, r.target_uri, r.date, r.source_digest) == \
            (s.source_id, s.target_uri, s.date, s.source_digest)
        assert (r.block_digest, r.content_length) == (digest(r.block), len(r.block.encode()))
    one = {r.record_type: r for r in made if r.source_id == 1}
    assert one["conversion"].block == "menu\nText ü one\ntwo\nz"
    s = by_id[one["metadata"].refers_to]
    assert s.source_digest == digest(PAGE)
    assert one["metadata"].block.split("\r\n") == [
        f"source-block-digest: {s.block_digest}", f"source-payload-digest: {digest(PAGE)}",
        "source-http-content-type: text/html; charset=utf-8",
        f"source-http-content-length: {len(PAGE.encode())}", "title: A & B C", "language: de",
        "outlink: /x?a=1&b", "outlink: y", ""]
    two = next(r for r in made if r.source_id == 2 and r.record_type == "conversion")
    assert (two.block, two.content_length, two.target_uri) == ("", 0, "http://a.example/2 X: y")


def test_files_give_the_records_back(spark, tmp_path):
    sources = w.responses(spark.createDataFrame(ROWS, DDL))
    records = sources.unionByName(w.derive(sources))
    for compression in ("gzip", "none"):
        path = str(tmp_path / compression)
        w.write(records, path, compression=compression, records_per_file=4)
        back = w.read(spark, path)
        columns = [c for c in records.columns if c != "source_id"]
        assert sorted(map(tuple, back.select(columns).collect()), key=repr) == \
            sorted(map(tuple, records.select(columns).collect()), key=repr)


def test_other_records_and_an_empty_table(spark):
    sources = w.responses(spark.createDataFrame(ROWS, DDL))
    assert w.derive(w.derive(sources)).count() == 0
    assert w.derive(w.responses(spark.createDataFrame([], DDL))).count() == 0
    assert w.http_parts("just a body") == ([], "just a body")
