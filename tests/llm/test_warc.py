import base64
import glob
import gzip
import hashlib

from vistaloom.llm import warc

ROWS = [
    (1, "http://a/x y\n", "<p>é</p>"),
    (7, "http://b", "<p>é</p>"),
    (3, None, "<p>é</p>"),
    (4, "http://c", None),
    (5, "http://c", ""),
    (6, "http://d", "z\r\n\r\nWARC/1.1\r\n" * 20000),
    (None, "http://n", "<p>é</p>"),
    (9, "u", "same"),
    (9, "u", "same"),
]


def test_round_trip(make, spark, tmp_path):
    pages = make([(*r, 5) for r in ROWS], "page_id long, url string, html string, payload_digest int")
    path = warc.write(warc.resolved(pages), archive_mb=1)
    got = warc.records(spark, path, payloads=True).collect()
    assert len(got) == len(ROWS)
    payload = {i: (h or "").encode() for i, _, h in ROWS}
    want = {1: 7, 3: 7, None: 7, 4: 5, 5: None, 6: None, 7: None, 9: None}
    for r in got:
        full = payload[r.page_id]
        assert r.refers_to == want[r.page_id] and (r.record_type == "revisit") == (r.refers_to is not None)
        assert r.payload_bytes == len(full)
        assert r.payload_digest == base64.b32encode(hashlib.sha1(full).digest()).decode()
        assert r.payload == (None if r.refers_to is not None else full)
    assert warc.export(spark, path, str(tmp_path)) >= 1
    back = [x for f in glob.glob(f"{tmp_path}/*.warc.gz") for x in warc.unpack(open(f, "rb").read())]
    assert sorted(map(repr, back)) == sorted(repr((*r[:7], None if r.payload is None else bytes(r.payload))) for r in got)


def headers(data):
    """The headers of all records of an archive file, by gzip alone."""
    whole, out = gzip.decompress(data), []
    while whole:
        head, _, rest = whole.partition(b"\r\n\r\n")
        out.append(dict(x.split(": ", 1) if ": " in x else (x, "") for x in head.decode().split("\r\n")[1:]))
        whole = rest[int(out[-1]["Content-Length"]) + 4 :]
    return out


def test_ids_are_unique_and_revisits_name_their_response(make, spark, tmp_path):
    rows = [*ROWS, (20, "a", "twice"), (20, "a", "twice"), (11, "b", "twice"), (11, "b", "twice"), (8, "q", "one"), (9, "q", "two")]
    path = warc.write(warc.resolved(make(rows, "page_id long, url string, html string")), date="2024-05-06T07:08:09Z")
    warc.export(spark, path, str(tmp_path))
    found = [h for f in glob.glob(f"{tmp_path}/*.warc.gz") for h in headers(open(f, "rb").read())]
    assert len(found) == len(rows) == len({h["WARC-Record-ID"] for h in found})
    assert {h["WARC-Date"] for h in found} == {"2024-05-06T07:08:09Z"}
    response = {h["WARC-Record-ID"]: h for h in found if h["WARC-Type"] == "response"}
    revisits = [h for h in found if h["WARC-Type"] == "revisit"]
    assert len(revisits) == 6
    for h in revisits:
        assert h["WARC-Refers-To-Date"] == "2024-05-06T07:08:09Z"
        to = h.get("WARC-Refers-To")
        # page 20 stands there twice, so its revisits name it by URL and date alone
        assert (to is None) == (h["X-Page-Id"] == "11")
        if to:
            assert response[to]["WARC-Payload-Digest"] == h["WARC-Payload-Digest"] and response[to]["X-Page-Id"] == h["X-Refers-To-Page-Id"]


def test_small_payloads_are_all_responses(make):
    pages = make(ROWS, "page_id long, url string, html string")
    assert warc.resolved(pages, least=10**9).filter("refers_to is not null").count() == 0


def test_empty(make, spark):
    path = warc.write(warc.resolved(make([], "page_id long, url string, html string")))
    assert warc.records(spark, path).count() == 0
