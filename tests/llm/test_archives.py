import hashlib
from collections import Counter

from contentlake.llm import archives

PAGES = "page_id bigint, url string, html string"


def _pages(spark, data):
    return spark.createDataFrame(data, PAGES).repartition(3)


def test_round_trip_and_revisits(spark):
    same, other = "<p>é</p>" * 40, "x" * 99
    data = [(3, "http://a.example/ b", same), (1, "http://a.example/é", same), (2, None, same), (4, "u", other), (5, "u", other), (6, "u", None),
            (7, "u", ""), (8, "http://b.example/\n?q=1", "y" * 100), (9, "u", "y" * 100), (10, "u", "line\r\n\r\nWARC/1.1\r\n" * 30), (11, "u", "z" * 500_000)]
    files = archives.convert_arc(archives.write_arc(_pages(spark, data), "page_id", "url", "html"))
    got = {int(r["key"]): r for r in archives.read_warc(files).collect()}
    assert set(got) == {d[0] for d in data}
    for key, _, text in data:
        raw = (text or "").encode()
        assert (got[key]["payload_bytes"], got[key]["payload_digest"]) == (len(raw), hashlib.sha256(raw).hexdigest())
        assert got[key]["intact"] and got[key]["date"] == "2024-01-01T00:00:00Z"
    assert {k: r["refers_to_key"] for k, r in got.items() if r["record_type"] == "revisit"} == {2: "1", 3: "1", 9: "8"}
    kept = [p for f in files.collect() for _, p in archives.payloads(f["path"])]
    assert Counter(kept) == Counter([same.encode(), other.encode(), other.encode(), b"", b"", b"y" * 100, data[9][2].encode(), data[10][2].encode()])
    assert len({r["record_id"] for r in got.values()}) == len(data)


def test_versions_have_their_own_record_lines(tmp_path):
    for version in (1, 2):
        path = str(tmp_path / f"{version}.arc.gz")
        roller = archives._Roller(str(tmp_path), ".arc.gz")
        block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n\r\nbody"
        roller.add(archives._arc_record(version, "http://a.example/ x", "19970102030405", block, 0, "f"), archives._arc_block(version, "f", "1997"))
        roller.close()
        (path, n), = roller.done
        (fields, got), = archives.read_arc(path)
        assert got == block and n == 1 and fields["date"] == "19970102030405" and fields["url"] == "http://a.example/%20x"
        assert len(fields) == len(archives.ARC_FIELDS[version])
        record = archives.warc_record(fields, got, archives.record_id(path, 0))
        assert b"WARC-Date: 1997-01-02T03:04:05Z" in record and b"WARC-Type: response" in record
    # a bare space in an old URL belongs to the URL; a block without HTTP head is a resource
    roller = archives._Roller(str(tmp_path), ".arc.gz")
    roller.add(b"ftp://a.example/x y 1.2.3.4 199701020304 text/plain 3\nabc\n", archives._arc_block(1, "f", "1997"))
    roller.close()
    (fields, got), = archives.read_arc(roller.done[0][0])
    assert fields["url"] == "ftp://a.example/x y" and got == b"abc"
    assert b"WARC-Type: resource" in archives.warc_record(fields, got, archives.record_id("f", 0))


def test_repeated_rows_null_keys_and_empty_table(spark):
    text = "q" * 120
    data = [(1, "u", text), (1, "u", text), (None, "u", text), (None, None, None)]
    out = archives.read_warc(archives.convert_arc(archives.write_arc(_pages(spark, data), "page_id", "url", "html"))).collect()
    assert Counter((r["key"], r["record_type"], r["refers_to_key"]) for r in out) == Counter(
        {("1", "response", None): 1, ("1", "revisit", "1"): 1, (None, "revisit", "1"): 1, (None, "response", None): 1})
    none = archives.write_arc(_pages(spark, data).limit(0), "page_id", "url", "html")
    assert archives.read_warc(archives.convert_arc(none)).count() == 0


def test_query_with_null_and_repeated_ids(spark, tmp_path):
    """Equal pages without id, and repeated ids with one url: identifiers are unique, revisits name their original."""
    from contentlake.llm.queries import op4_warc

    text, other = "r" * 150, "s" * 150
    data = [(None, "u", text), (None, "u", text), (None, "u", text), (7, "v", other), (7, "v", other), (None, "v", other), (8, "v", "short")]
    _pages(spark, data).write.parquet(str(tmp_path / "pages.parquet"))
    out = op4_warc(spark, str(tmp_path)).collect()
    assert Counter((r["page_id"], r["record_type"], r["refers_to"]) for r in out) == Counter(
        {(None, "response", None): 1, (None, "revisit", None): 2, (7, "response", None): 1, (7, "revisit", 7): 1, (None, "revisit", 7): 1, (8, "response", None): 1})
    files = archives.convert_arc(archives.write_arc(_pages(spark, data), "page_id", "url", "html"))
    records = archives.read_warc(files).collect()
    by_id = {r["record_id"]: r for r in records}
    assert len(by_id) == len(data) and all(r["intact"] for r in records)
    for r in records:
        if r["record_type"] == "revisit":
            original = by_id[r["refers_to"]]
            assert original["record_type"] == "response" and original["payload_digest"] == r["payload_digest"]
