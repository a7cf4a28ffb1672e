"""A lookup gives a revisit the payload of its response."""

from tallyloom.llm import warc
from tallyloom.llm.common import shared_folder


def test_a_revisit_has_its_full_payload(spark):
    payloads = ["<p>ä</p>" * 300, "<b>other</b>" * 200, "short"]
    pages = [(i, f"http://site{i % 4}.example/p/{i}", payloads[i % 3]) for i in range(60)]
    pages += [(None, "http://no.id/", payloads[0]), (57, "http://again.example/", payloads[0]), (60, "http://alone.example/", "x" * 2000)]
    archives = warc.write_archives(spark.createDataFrame(pages, "page_id long, url string, html string").repartition(5), shared_folder(spark, "warc"))
    directory = warc.write_index(warc.read_archives(archives), shared_folder(spark, "index"))
    held = warc.lookup(directory, [u for _, u, _ in pages])
    assert sorted((repr(r["page_id"]), r["url"], r["payload"].decode()) for r in held) == sorted((repr(p), u, h) for p, u, h in pages)
    assert sum(r["record_type"] == "revisit" for r in held) == 39
    assert all((r["payload_archive"] is None) == (r["record_type"] == "response") for r in held)
    assert warc.scan_index(directory).count() == len(pages)
