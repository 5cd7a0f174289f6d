"""Manifest files, batch and stream."""

import pytest

from sheafwork.operators import manifest_path
from sheafwork import plans
from sheafwork.sources import (
    WRITE_OPTIONS,
    scan_manifest,
    scan_manifest_checked,
    store_checked,
    stream_manifest,
    stream_manifest_checked,
)
from sheafwork.streaming import append_available

HEADER = "mid,base_directory,file_name\n"
BOM = b"\xef\xbb\xbf"


def write(folder, name, text, bom=False):
    (folder / name).write_bytes((BOM if bom else b"") + text.encode())


def paths(frame):
    rows = manifest_path(frame).orderBy("mid").collect()
    return [(r["mid"], r["base_directory"], r["file_name"], r["path"]) for r in rows]


def test_files_with_and_without_mark(spark, tmp_path):
    write(tmp_path, "one.csv", HEADER + "a,/in,a.dat\nb,/in/,b.dat\n", bom=True)
    write(tmp_path, "two.csv", HEADER + 'c,/,c.dat\nd,/x//,/d.dat\ne,"/y,z",e.dat\n')
    assert paths(scan_manifest(spark, str(tmp_path))) == [
        ("a", "/in", "a.dat", "/in/a.dat"),
        ("b", "/in/", "b.dat", "/in/b.dat"),
        ("c", "/", "c.dat", "/c.dat"),
        ("d", "/x//", "/d.dat", "/x/d.dat"),
        ("e", "/y,z", "e.dat", "/y,z/e.dat"),
    ]


def test_empty_fields_are_null(spark, tmp_path):
    write(tmp_path, "one.csv", HEADER + "a,/in,\nb,,b.dat\n,/c,c.dat\n")
    assert paths(scan_manifest(spark, str(tmp_path))) == [
        (None, "/c", "c.dat", "/c/c.dat"),
        ("a", "/in", None, None),
        ("b", None, "b.dat", None),
    ]


def test_text_is_not_guessed(spark, tmp_path):
    write(tmp_path, "one.csv", HEADER + "007,/in,1.50\n")
    assert paths(scan_manifest(spark, str(tmp_path))) == [("007", "/in", "1.50", "/in/1.50")]


@pytest.mark.parametrize("header", ["id,base_directory,file_name\n", "mid,file_name\n"])
def test_wrong_header_fails(spark, tmp_path, header):
    write(tmp_path, "one.csv", HEADER + "a,/in,a\n")
    write(tmp_path, "two.csv", header + "b,/in,b\n")
    with pytest.raises(Exception, match="(?i)header"):
        scan_manifest(spark, str(tmp_path)).collect()


@pytest.mark.parametrize("row", ["a,/d\n", "b,/d,x,y\n"])
def test_rows_of_another_length_fail(spark, tmp_path, row):
    write(tmp_path, "one.csv", HEADER + row)
    for frame in (scan_manifest(spark, str(tmp_path)), scan_manifest(spark, str(tmp_path)).select("mid")):
        with pytest.raises(Exception, match="(?i)malformed"):
            frame.collect()


def test_quotes_line_ends_and_white_space(spark, tmp_path):
    rows = HEADER + 'a,/d,"x ""q"" y.txt"\nb,/d," z "\nc,/d, w \n'
    write(tmp_path, "one.csv", rows)
    assert [x[2] for x in paths(scan_manifest(spark, str(tmp_path)))] == ['x "q" y.txt', " z ", " w "]
    write(tmp_path, "two.csv", HEADER + 'd,/d,"two\nlines"\n')
    assert [x[2] for x in paths(scan_manifest(spark, str(tmp_path), multi_line=True))][3] == "two\nlines"


def test_addresses_come_back(spark, tmp_path):
    urls = [" http://a/b ", "http://a/b\nc", "plain", "http://a/", 'http://a/"q".x', "http://a/b,c", "/", None]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    rows = plans.page_manifest(pages)
    rows.write.options(**WRITE_OPTIONS).csv(str(tmp_path / "files"))
    back = scan_manifest(spark, str(tmp_path / "files"), multi_line=True)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, rows.collect()))


def test_stream(spark, tmp_path):
    source, sink = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()

    def run():
        rows = manifest_path(stream_manifest(spark, str(source), max_files_per_trigger=1))
        (
            rows.writeStream.format("parquet")
            .option("path", sink)
            .option("checkpointLocation", str(tmp_path / "progress"))
            .trigger(availableNow=True)
            .start()
            .awaitTermination()
        )
        return sorted(r["path"] for r in spark.read.parquet(sink).collect())

    write(source, "one.csv", HEADER + "a,/in,a\n", bom=True)
    write(source, "two.csv", HEADER + "b,/in/,b\n")
    assert run() == ["/in/a", "/in/b"]
    write(source, "three.csv", HEADER + "c,/in,c\n")
    assert run() == ["/in/a", "/in/b", "/in/c"]


def test_good_rows_and_rejects(spark, tmp_path):
    (tmp_path / "in").mkdir()
    write(tmp_path / "in", "one.csv", HEADER + "a,/in,a.dat\nb,/in\nc,/in,c,d\n\ne,/in,\n", bom=True)
    write(tmp_path / "in", "two.csv", HEADER + 'f,"/x,y",f.dat\n"g,h"\n"i,j",k,"l,m","n ""o, p"" q"\nr\n')
    rows = scan_manifest_checked(spark, str(tmp_path / "in"))
    good, rejects = store_checked(rows, str(tmp_path / "out"))
    for found in (good, rows.where("rejected IS NULL").select("mid", "base_directory", "file_name")):
        assert sorted(map(tuple, found.collect())) == [
            ("a", "/in", "a.dat"),
            ("e", "/in", None),
            ("f", "/x,y", "f.dat"),
        ]
    for found in (rejects, rows.where("rejected IS NOT NULL").select("rejected.*")):
        assert sorted((r.file.rsplit("/", 1)[1], r.row, r.fields) for r in found.collect()) == [
            ("one.csv", "b,/in", 2),
            ("one.csv", "c,/in,c,d", 4),
            ("two.csv", '"g,h"', 1),
            ("two.csv", '"i,j",k,"l,m","n ""o, p"" q"', 4),
            ("two.csv", "r", 1),
        ]
    assert rows.select("rejected").where("rejected IS NOT NULL").count() == 5
    assert rows.where("rejected IS NOT NULL AND (mid IS NOT NULL OR base_directory IS NOT NULL)").isEmpty()


def test_rejects_over_several_lines_and_a_wrong_header(spark, tmp_path):
    write(tmp_path, "one.csv", HEADER + 'a,"/in\nx",a\nb,"c\nd"\n')
    rows = scan_manifest_checked(spark, str(tmp_path), multi_line=True).collect()
    assert [r.base_directory for r in rows if r.rejected is None] == ["/in\nx"]
    assert [(r.rejected.row.strip(), r.rejected.fields) for r in rows if r.rejected] == [('b,"c\nd"', 2)]
    write(tmp_path, "two.csv", "mid,file_name\nb,b\n")
    with pytest.raises(Exception, match="(?i)header"):
        scan_manifest_checked(spark, str(tmp_path)).collect()


def test_rejects_of_a_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    found = []
    for name, text in ("one", "a,/in,a\nb\n"), ("two", "c,d,e,f\ng,/in,g\n"):
        write(tmp_path / "in", f"{name}.csv", HEADER + text)
        rows = stream_manifest_checked(spark, str(tmp_path / "in"), max_files_per_trigger=1)
        append_available(rows, str(tmp_path / "out"), str(tmp_path / "progress")).awaitTermination()
        back = spark.read.schema(rows.schema).parquet(str(tmp_path / "out")).collect()
        found.append((sorted(r.mid for r in back if r.mid), sorted(r.rejected.row for r in back if r.rejected)))
    assert found == [(["a"], ["b"]), (["a", "g"], ["b", "c,d,e,f"])]
