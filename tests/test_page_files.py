import hashlib
import os

from brindle.plans import q01_sources as q01
from brindle.sources import files


def test_small_pages_are_written_by_many_tasks(spark, tmp_path, monkeypatch):
    """Pages of few bytes used to be put together into one writing task."""
    rows = [(i, f"<p>{i}</p>\n" * (i % 3)) for i in range(60)]
    spark.createDataFrame(rows, "page_id bigint, html string").write.parquet(str(tmp_path / "pages.parquet"))
    monkeypatch.setattr(q01, "FILES_A_TASK", 3)
    out = q01.read_text_docs(spark, str(tmp_path))
    files = [f.rsplit("/", 1)[-1].split("-")[1] for f in out.inputFiles()]
    assert len(files) == 60 and len(set(files)) >= 8
    assert {r.page_id: r.n_chars for r in out.collect()} == {i: len(t) for i, t in rows}


def test_files_lie_where_tasks_wrote_them(spark, tmp_path):
    """Each file used to be renamed by the driver, and to need processes of its own for its rights."""
    rows = [(i, f"ä{i}\n" * (i % 4)) for i in range(-3, 30)] + [(None, "no id"), (31, None), (40, "a"), (40, "a")]
    pages = spark.createDataFrame(rows, "page_id bigint, html string")
    folders = files.write_text_docs(pages, "page_id", "html", f"{tmp_path}/docs", 5)
    assert 1 < len(folders) <= 5 and sorted(f"{tmp_path}/docs/{p}" for p in os.listdir(tmp_path / "docs")) == sorted(folders)
    assert not [f for d in folders for f in os.listdir(d) if f.endswith(".crc")]
    for plain in (True, False):
        found = {r["name"].split("key=")[1]: r["text"] for r in files.read_text_docs(spark, folders, plain).collect()}
        assert found == {f"{i}.txt": t + "\n" for i, t in rows if i is not None and i < 30} | {".txt": "no id\n", "31.txt": "\n", "40.txt": "a\na\n"}


def test_pages_without_an_id_and_no_pages(spark, tmp_path):
    for name, rows in (("some", [(-2, "x"), (None, "y\n\n"), (3, "")]), ("none", [])):
        spark.createDataFrame(rows, "page_id bigint, html string").write.parquet(f"{tmp_path}/{name}/pages.parquet")
        out = q01.read_text_docs(spark, f"{tmp_path}/{name}").collect()
        assert sorted(out, key=str) == sorted([(i, len(t), hashlib.md5(t.encode()).hexdigest()) for i, t in rows], key=str)
