import gzip
import hashlib
import os

from bitext.llm import warc
from bitext.session import scratch_path

SCHEMA = "page_id long, url string, html string, sha1 string, member string"


def read(spark, path):
    return warc.read_archives(spark, path).where("kind = 'record'").collect()


def test_round_trip_and_revisits(spark):
    big, other = "<p>" + "ä" * 600 + "</p>", "y" * 1000
    rows = [(1, "http://a/1", big, "s", "m"), (9, "http://b/9", big, "s", "m"), (4, None, big, None, None), (5, "http://c/5", "small", "", ""), (6, "http://c/6", "small", "", ""),
            (7, "u\r\nEvil: x", None, "", ""), (8, "", "", "", ""), (10, "http://d", other, "", ""), (None, "http://n", other, "", ""), (11, "http://e", "z" * 999, "", ""), (12, "http://e", "z" * 999, "", "")]
    path = scratch_path(spark, "warc-test")
    warc.write_archives(spark.createDataFrame(rows, SCHEMA), path)
    got = {r["page_id"]: r for r in read(spark, path)}
    assert len(got) == 11
    for page_id, _, html, _, _ in rows:
        body = (html or "").encode()
        assert got[page_id]["payload_bytes"] == len(body)
        assert got[page_id]["payload_digest"] == hashlib.sha1(body).hexdigest()
        if got[page_id]["record_type"] == "response":
            assert bytes(got[page_id]["payload"]) == body
    assert {i: (r["record_type"], r["refers_to"]) for i, r in got.items() if r["record_type"] != "response"} == {1: ("revisit", 9), 4: ("revisit", 9), None: ("revisit", 10)}
    assert got[7]["url"] == "u Evil: x"
    # the files are plain multi-member gzip
    names = [os.path.join(path, n) for n in os.listdir(path) if n.startswith("part-")]
    assert sum(gzip.open(n).read().count(b"WARC/1.1\r\n") for n in names) == 11


def test_repeated_rows_and_empty_table(spark):
    path = scratch_path(spark, "warc-test")
    warc.write_archives(spark.createDataFrame([(3, "u", "q" * 2000, "", "")] * 2, SCHEMA), path)
    assert [(r["page_id"], r["record_type"]) for r in read(spark, path)] == [(3, "response")] * 2
    path = scratch_path(spark, "warc-test")
    warc.write_archives(spark.createDataFrame([], SCHEMA), path)
    assert read(spark, path) == []


def members(n):
    out = []
    for i in range(n):
        body = (f"payload {i} " * 40).encode()
        out.append(warc.gzip_member(warc.build_record(i, f"http://h/{i}", body, hashlib.sha1(body).hexdigest(), None)))
    return out


def seen(data):
    return [(k, a, b, x if k == "gap" else int(x["head"]["x-page-id"])) for k, a, b, x in warc.salvage(data)]


def test_salvage_of_a_damaged_member():
    parts = members(5)
    starts = [sum(map(len, parts[:i])) for i in range(6)]
    data = bytearray(b"".join(parts))
    data[starts[2] + 30] ^= 0x55
    got = seen(bytes(data))
    assert [x[3] for x in got if x[0] == "record"] == [0, 1, 3, 4]
    assert [x[:3] for x in got if x[0] == "gap"] == [("gap", starts[2], starts[3])]


def test_salvage_of_junk_and_a_cut_end():
    parts = members(4)
    data = b"\x1f\x8b\x08 not a member" + b"".join(parts)[:-7]
    got = seen(data)
    assert [x[3] for x in got if x[0] == "record"] == [0, 1, 2]
    gaps = [x for x in got if x[0] == "gap"]
    assert gaps[0][1:3] == (0, 16) and gaps[-1][2] == len(data)
    # every byte is in a record or in a gap
    assert sum(b - a for _, a, b, _ in got) == len(data)


def test_salvage_of_plain_records():
    plain = [gzip.decompress(m) for m in members(4)]
    data = plain[0] + plain[1][:-60] + plain[1][-50:] + b"noise\r\n" + plain[2] + plain[3].replace(b"payload 3", b"payl0ad 3", 1)
    got = seen(data)
    assert [x[3] for x in got if x[0] == "record"] == [0, 2]
    assert {x[3] for x in got if x[0] == "gap"} == {"record length", "block digest"}
    assert sum(b - a for _, a, b, _ in got) == len(data)


def test_member_over_the_zero_byte_limit():
    body = b"a" * (17 << 20)
    member = warc.gzip_member(warc.build_record(1, "u", body, hashlib.sha1(body).hexdigest(), None))
    assert member[-1] == 0
    assert [x[0] for x in seen(member + members(1)[0])] == ["record", "record"]


def test_plain_records_may_hold_members():
    """Valid uncompressed records come back whole, whatever their payloads hold."""
    inner = gzip.compress(b"WARC/1.1\r\nnot a record of this file" * 9)
    plain = [warc.build_record(i, f"http://h/{i}", body, hashlib.sha1(body).hexdigest(), None) for i, body in enumerate([b"a" * 50, inner, b"c" * 50])]
    assert [(k, x) for k, _, _, x in seen(b"".join(plain))] == [("record", 0), ("record", 1), ("record", 2)]
    broken = bytearray(b"".join(plain))
    broken[len(plain[0]) + 5 : len(plain[0]) + 8] = b"x.x"
    found = seen(bytes(broken))
    assert [x for k, _, _, x in found if k == "record"] == [0, 2] and any(k == "gap" for k, *_ in found)
    # a member after plain records
    assert [x for _, _, _, x in seen(plain[0] + members(4)[3] + plain[2])] == [0, 3, 2]
