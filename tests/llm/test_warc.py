import hashlib

from rinkframe.llm import warc


def test_round_trip_and_revisits(spark):
    big = "é" * 900_000
    rows = [(1, "http://a/ b?q=1é", big, 0), (2, None, big, 0), (9, "u", "x" * 1000, 0), (5, "u", "x" * 1000, 0), (6, "u", "y" * 999, 0), (7, "u", "y" * 999, 0), (8, "u", None, 0), (4, "u", "", 0), (None, "u", "x" * 1000, 0), (11, "u", "z\r\n\r\n" * 400, 0), (11, "u", "z\r\n\r\n" * 400, 0)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, digest int")
    manifest = warc.write(warc.chunks(warc.classify(pages), 1 << 16))
    got = warc.read(manifest).collect()
    last = sorted(((r.page_id, r.payload_bytes, r.digest, r.record_type, r.refers_to) for r in got if r.last), key=str)
    want = []
    for page, _, html, _ in rows:
        data = (html or "").encode()
        same = [r[0] for r in rows if (r[2] or "") == (html or "") and r[0] is not None]
        again = len(data) >= 1000 and same and max(same) != page
        want.append((page, len(data), hashlib.sha1(data).hexdigest(), "revisit" if again else "response", max(same) if again else None))
    assert last == sorted(want, key=str)
    text = b"".join(bytes(r.data) for r in sorted((r for r in got if r.page_id == 2), key=lambda r: r.chunk))
    assert text.decode() == big
    urls = {r.page_id: r.url for r in got}
    assert urls[1] == "http://a/ b?q=1é" and urls[2] is None


def test_empty_table(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.read(warc.write(warc.chunks(warc.classify(pages)))).count() == 0
