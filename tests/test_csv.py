import os

from wideloom.sources.csv import file_encodings, parse_csv, read_csv_text


def write(tmp_dir, name, data: bytes):
    p = os.path.join(tmp_dir, name)
    with open(p, "wb") as f:
        f.write(data)
    return p


def test_ragged_rows(spark, tmp_dir):
    p = write(tmp_dir, "r.csv", b"a,b\n1,x,EXTRA\n2\nzz,y\n")
    df = read_csv_text(spark, p).drop("_src_file", "_src_block", "_src_row")
    assert [tuple(r) for r in df.orderBy("a").collect()] == [("1", "x"), ("2", None), ("zz", "y")]


def test_quotes_and_line_breaks(spark, tmp_dir):
    p = write(tmp_dir, "q.csv", b'a,b\n"he said ""hi""","line1\nline2"\n')
    r = read_csv_text(spark, p).first()
    assert r.a == 'he said "hi"' and r.b == "line1\nline2"


def test_latin1_detected(spark, tmp_dir):
    p = write(tmp_dir, "l.csv", b"name,n\ncaf\xe9,1\n")
    assert list(file_encodings(spark, p).values()) == ["ISO-8859-1"]
    df, _ = parse_csv(spark, p)
    r = df.first()
    assert r.name == "café" and r.n == 1


def test_bom_not_in_header(spark, tmp_dir):
    p = write(tmp_dir, "b.csv", "﻿col,v\nx,1\n".encode("utf-8"))
    df, _ = parse_csv(spark, p)
    assert df.columns == ["col", "v"]


def test_types_from_csv(spark, tmp_dir):
    rows = "\n".join(f"{i},{i}.5,{'true' if i % 2 else 'false'},2024-03-0{i % 9 + 1}" for i in range(50))
    p = write(tmp_dir, "t.csv", ("i,f,b,d\n" + rows + "\n").encode())
    df, dec = parse_csv(spark, p)
    assert df.dtypes == [("i", "bigint"), ("f", "double"), ("b", "boolean"), ("d", "string")]
    assert df.count() == 50


def test_multiline_only_where_needed(spark, tmp_dir):
    from wideloom.sources.csv import file_profiles
    a = write(tmp_dir, "plain.csv", b'a,b\n"x ""q""",1\n')
    b = write(tmp_dir, "multi.csv", b'a,b\n"line1\nline2",2\n')
    prof = {os.path.basename(k): v[:2] for k, v in file_profiles(spark, [a, b]).items()}
    assert prof == {"plain.csv": ("UTF-8", False), "multi.csv": ("UTF-8", True)}
    df = read_csv_text(spark, [a, b]).drop("_src_file", "_src_block", "_src_row")
    assert sorted(tuple(r) for r in df.collect()) == [("line1\nline2", "2"), ('x "q"', "1")]


def test_quoted_empty_is_text_absent_is_null(spark, tmp_dir):
    p = write(tmp_dir, "e.csv", b'a,b\n"",x\n,y\n"z",w\n')
    df, _ = parse_csv(spark, p)
    assert [tuple(r) for r in df.collect()] == [("", "x"), (None, "y"), ("z", "w")]


def test_repeated_and_blank_header_names(spark, tmp_dir):
    df, _ = parse_csv(spark, write(tmp_dir, "d.csv", b"a,A,\n1,2,3\n"))
    assert df.columns == ["a", "A_2", "_c2"]
    assert [tuple(r) for r in df.collect()] == [(1, 2, 3)]
    q = write(tmp_dir, "blank.csv", b"a,,c\n1,2,3\n")
    df, _ = parse_csv(spark, q)
    assert df.columns == ["a", "_c1", "c"]


def test_names_of_files_and_columns(spark, tmp_dir):
    """Spaces, brackets, percent signs and non-ASCII letters in file names; dots in headers."""
    for name in ("Borough Level (Historical).csv", "a+b%20c.csv", "Bezirk \u00fc.csv"):
        df, _ = parse_csv(spark, write(tmp_dir, name, b"Acct.Bal,No. of `x`\n1,y\n"))
        assert df.dtypes == [("Acct.Bal", "bigint"), ("No. of `x`", "string")]
        assert [tuple(r) for r in df.collect()] == [(1, "y")]


def test_each_file_has_its_own_header(spark, tmp_dir):
    d = os.path.join(str(tmp_dir), "mixed [1]")
    os.mkdir(d)
    for name, data in (("a.csv", b"x,y\n1,p\n"), ("b.csv", b"y,x\nq,2\n"), ("c.csv", b"x,y\n3,r\n"),
                       ("d [2].csv", b"y,z\ns,4\n")):
        with open(os.path.join(d, name), "wb") as f:
            f.write(data)
    df, _ = parse_csv(spark, os.path.join(str(tmp_dir), "mixed ?1?"))
    assert df.dtypes == [("x", "bigint"), ("y", "string"), ("z", "bigint")]
    rows = sorted((tuple(r) for r in df.collect()), key=str)
    assert rows == [(1, "p", None), (2, "q", None), (3, "r", None), (None, "s", 4)]


def test_header_only_and_empty_files(spark, tmp_dir):
    import pytest
    h = write(tmp_dir, "h.csv", b"a,b\n")
    df, _ = parse_csv(spark, h)
    assert df.dtypes == [("a", "string"), ("b", "string")] and df.count() == 0
    e = write(tmp_dir, "e0.csv", b"")
    with pytest.raises(Exception):
        parse_csv(spark, e)
