"""Extracts read by records: every line is a row whatever its blanks, and files are read in splits whatever their cells."""

import csv
import io
import random

import pytest

from twinledger.sources.extracts import cells, extract_counts, read_extract


def python_rows(text, delimiter=","):
    """Rows below the header as Python's reader gives them, padded and cut to the header."""
    header, *rows = csv.reader(io.StringIO(text, newline=""), delimiter=delimiter)
    wide = [(r + [None] * len(header))[: len(header)] for r in rows]
    clean = [tuple(c.replace("\r\n", "\n").replace("\r", "\n") if c else c for c in r) for r in wide]
    return clean, sum(len(r) != len(header) for r in rows)


def written(tmp_path, text, name="x.csv", encoding="utf-8"):
    path = tmp_path / name
    path.write_bytes(text.encode(encoding))
    return str(path)


def in_order(extract):
    found = extract.df.orderBy("__file", "__block", "__line").collect()
    return [tuple(r[c] for c in extract.columns) for r in found]


@pytest.mark.parametrize(
    ("text", "delimiter"),
    [
        ("a\tb\tc\n1\t2\t3\n\t\t\n4\t5\t6\n", "\t"),  # only blanks between tabs
        ("a\tb\tc\n \t \t \n\n\t\n", "\t"),
        ("a\n1\n\t\n \n\n2\n", ","),
        ("a,b\n1,2\n\x01\x02,\n,\n", ","),
        ('a,b\n1,"x\ny"\n\n\n2,"\n\n"\n3,z\n', ","),  # blank lines inside and outside cells
        ('a,b\r\n1,"x\r\ny"\r\n\r\n2,z\r\n', ","),
        ('a,b\n1,"say ""hi"""\n2,""\n3,""""\n4,"a""\n""b"\n', ","),
        ('a,b\n1,5" pipe\n2,x"y"z\n3,"ok"\n', ","),  # quotes inside unquoted cells open nothing
        ('"a\nx",b\n1,2\n', ","),  # a header of two lines
        ('a,b\n1,2\n3,"never closed\n4,5\n6,7', ","),
        ("a,b\n1,2,3\n4\n", ","), ("a;b\n1;'x;y'\n\"2;2\";3", ";"), ("a,b", ","), ("a,b\r1,2\r3,4\r", ","),
        ("a||b\n1||2\n\"x||y\"||3\n||\n", "||"),
    ],
)
def test_rows_are_those_of_a_record_reader(spark, tmp_path, text, delimiter):
    found = read_extract(spark, written(tmp_path, text), delimiter=delimiter)
    if len(delimiter) > 1:
        assert sorted(in_order(found)) == [("", ""), ("1", "2"), ("x||y", "3")]
        return
    rows, ragged = python_rows(text, delimiter)
    assert in_order(found) == rows
    assert tuple(extract_counts(found.df).first()) == (len(rows), ragged)


def hostile(seed, n=300):
    random.seed(seed)
    out = io.StringIO(newline="")
    make = lambda: "".join(random.choice(['x', ' ', '"', ',', '\n', 'é', '""', '\n\n', "y,", '",']) for _ in range(random.randrange(7)))
    write = csv.writer(out, lineterminator="\n")
    write.writerow(["a", "b", "c"])
    for _ in range(n):
        if random.random() < 0.15:
            out.write(random.choice(["\n", ",,\n", 'p"q,r\n', "1,2\n", "1,2,3,4\n"]))
        else:
            write.writerow([make(), make(), make()])
    return out.getvalue()


@pytest.mark.parametrize("seed", range(2))
def test_splits_do_not_change_the_rows(spark, tmp_path, seed):
    text = hostile(seed)
    path = written(tmp_path, text)
    rows, ragged = python_rows(text)
    whole = read_extract(spark, path)
    assert whole.df.rdd.getNumPartitions() <= 4 and in_order(whole) == rows
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(max(40, len(text.encode()) // 64)))
    try:
        split = read_extract(spark, path)
        assert in_order(split) == rows and tuple(extract_counts(split.df).first()) == (len(rows), ragged)
        assert split.df.select("__block").distinct().count() > 30  # no task had the file to itself
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


@pytest.mark.parametrize("encoding", ["utf-16", "utf-16-le", "iso-8859-1", "cp1252"])
def test_other_encodings(spark, tmp_path, encoding):
    text = 'id,name\n1,Zoë\n\n2,"Ünal,\nÅsa"\n'
    found = read_extract(spark, written(tmp_path, text, encoding=encoding), encoding={"utf-16-le": "utf-16le"}.get(encoding, encoding))
    assert in_order(found) == python_rows(text)[0]


def test_parts_with_line_breaks_and_other_headers(spark, tmp_path):
    paths = [written(tmp_path, t, f"p{i}.csv") for i, t in enumerate(['id,a\n1,"x\n\ny"\n', 'a,id,b\nz,2,\n\n', '3,"q\nr"\n'])]
    found = read_extract(spark, paths)
    assert found.columns == ["id", "a", "b"]
    assert in_order(found) == [("1", "x\n\ny", None), ("2", "z", ""), (None, None, None), ("3", "q\nr", None)]


def test_plans_of_both_ways(spark, tmp_path):
    plain = read_extract(spark, written(tmp_path, "a,b\n1,2\n", "p.csv")).df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plain and "Window" not in plain
    broken = read_extract(spark, written(tmp_path, 'a,b\n1,"2\n3"\n', "b.csv"))
    assert "Window" in broken.df._jdf.queryExecution().executedPlan().toString() and cells(broken).count() == 1


def test_very_long_cells_need_no_stack(spark, tmp_path):
    cell = 'x ""y"" z,' * 20_000
    paths = [written(tmp_path, t, f"p{i}.csv") for i, t in enumerate(["id,a\n1,x\n", f'2,"{cell}"\n3,"{cell}",more\n'])]
    found = in_order(read_extract(spark, paths))
    assert [r[0] for r in found] == ["1", "2", "3"] and found[1][1] == found[2][1] == cell.replace('""', '"')
