"""Files of more bytes than Spark can hold in one row."""

from pyspark.sql import functions as F

from docweave.functions.media import media_type
from docweave.sources import folder

EDGE = 4 << 20  # larger files are not read by tasks


def test_types_of_large_files(spark, tmp_path):
    heads = {
        "beyond one array.parquet": (b"PAR1", (1 << 31) + 100),
        "x/large page %20": (b" <HTML><body>", EDGE + 1),
        "x/large.csv": (b"\x00", EDGE + 1),
        "x/bytes": (b"\x01", EDGE + 1),
        "whole": (b"%PDF-1.7", EDGE),
        "small.txt": (b"body", 4),
        "x/PROCESSED_FILES/copy.html": (b"<html>", EDGE + 1),
    }
    for name, (head, length) in heads.items():
        f = tmp_path / name
        f.parent.mkdir(parents=True, exist_ok=True)
        with f.open("wb") as out:
            out.write(head)
            out.truncate(length)  # no disk is used for the rest
    del heads["x/PROCESSED_FILES/copy.html"]
    files = folder.with_media_type(folder.folder_scan(spark, str(tmp_path)))
    assert files.columns == ["path", "modified", "length", "content", "content_type"]
    got = {r.path.split(f"{tmp_path}/")[1]: (r.length, r.content_type) for r in files.select("path", "length", "content_type").collect()}
    rows = [(name, bytearray(head + bytes(min(64, length) - len(head)))) for name, (head, length) in heads.items()]
    kinds = spark.createDataFrame(rows, "name string, head binary").select("name", media_type(F.col("head"), F.col("name")).alias("kind"))
    assert got == {r.name: (heads[r.name][1], r.kind) for r in kinds.collect()}
    assert got["beyond one array.parquet"][1] == "application/vnd.apache.parquet" and got["x/large page %20"][1] == "text/html"
    assert [bytes(r.content) for r in files.where("length = 4").select("content").collect()] == [b"body"]


def test_content_of_large_files_can_still_be_read(spark, tmp_path):
    for name, body in {"a": b"%PDF-" + bytes(EDGE), "b": b"text"}.items():
        (tmp_path / name).write_bytes(body)
    registry = folder.ReaderRegistry()
    registry.register("application/pdf", lambda df: df.select(F.sha2("content", 256).alias("h"), F.octet_length("content").alias("n")))
    rows = registry.read(folder.folder_scan(spark, str(tmp_path)))["application/pdf"].collect()
    assert [r.n for r in rows] == [EDGE + 5]
