"""The shuffle of the archives carries compressed payloads."""

import zstandard

from brindle.llm.warc import assign_types


def test_payloads_are_shuffled_packed_and_come_out_whole(spark):
    texts = {1: "<p>ä\x00€</p>" * 500, 2: "", 3: None}
    rows = assign_types(spark.createDataFrame([(k, "http://x/", v) for k, v in texts.items()], "page_id long, url string, html string"))
    assert "html" not in rows.columns
    found = {r["page_id"]: bytes(r["packed"]) for r in rows.collect()}
    assert {k: zstandard.ZstdDecompressor().decompress(v).decode() for k, v in found.items()} == {k: v or "" for k, v in texts.items()}
    assert len(found[1]) < 500
