"""A page_id that carries several payloads, long payloads and columns with clashing names."""

from quantweave.llm.warc import archive


def test_each_payload_of_a_page_keeps_its_bytes(spark):
    long = "y" * 3_000_000
    pages = [(1, "xxxxx"), (1, "different page"), (2, "xxxxx"), (2, "different page"), (2, "different page"), (3, "own"), (3, None), (1, long), (4, long)]
    rows = [(page, "u", html, 7, "s", 9) for page, html in pages]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, size int, same string, refers_to long").repartition(3)
    found = archive(df).collect()
    expected = []
    for page, html in pages:
        top = max(other for other, more in pages if more == html)
        raw = (html or "").encode()
        expected.append((page, len(raw), None if top == page else top, raw if top == page else b""))
    body = next(name for name, kind in archive(df).dtypes if kind == "binary")
    got = [(row["page_id"], row["payload_bytes"], row["refers_to"], bytes(row[body])) for row in found]
    assert sorted(got, key=str) == sorted(expected, key=str)
    # No payload is lost: every html is the body of some record.
    assert {(html or "").encode() for _, html in pages} <= {one[3] for one in got}
