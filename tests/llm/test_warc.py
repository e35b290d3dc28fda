import hashlib

from stormledger.llm import warc

PAGES = "page_id long, url string, html string, digest string"


def read(spark, pages, **options):
    index = warc.write_archives(warc.mark_revisits(spark.createDataFrame([(*p, "clash") for p in pages], PAGES)))
    return index, warc.read_records(index, **options)


def test_revisits_and_payloads(spark):
    big, small = "é" * 600, "x" * 999
    pages = [(1, "http://a/\r\nX: y", big), (7, "http://b", big), (3, None, big), (4, "u", small), (5, "u", small), (6, "u", None), (8, "u", "")]
    index, records = read(spark, pages)
    got = {r.page_id: r for r in records.collect()}
    assert {k: (r.record_type, r.refers_to) for k, r in got.items()} == {
        1: ("revisit", 7), 7: ("response", None), 3: ("revisit", 7),
        4: ("response", None), 5: ("response", None), 6: ("response", None), 8: ("response", None),
    }
    for k, _, html in pages:
        raw = (html or "").encode()
        assert (got[k].payload_bytes, got[k].payload_digest) == (len(raw), hashlib.sha1(raw).hexdigest())
    whole = {r.page_id: bytes(r.payload) for r in warc.resolve_revisits(records).collect()}
    assert all(whole[k] == (html or "").encode() for k, _, html in pages)
    one = warc.read_records(index.where("page_id = 4"), payloads=False).collect()
    assert [(r.page_id, r.payload) for r in one] == [(4, None)]


def test_repeated_rows_and_empty_table(spark):
    big = "y" * 1500
    _, records = read(spark, [(2, "u", big), (2, "u", big), (1, "u", big), (None, "u", big)])
    got = sorted(((r.page_id, r.record_type, r.refers_to) for r in records.collect()), key=str)
    assert got == [(1, "revisit", 2), (2, "response", None), (2, "response", None), (None, "revisit", 2)]
    assert read(spark, [])[1].count() == 0


def test_neighbouring_ranges_are_one_read():
    row = lambda f, o, n: {"file": f, "offset": o, "length": n}
    runs = list(warc.coalesced([row("a", 0, 10), row("a", 10, 5), row("a", 10_000_000, 5), row("b", 0, 1)]))
    assert [len(r) for r in runs] == [2, 1, 1]
