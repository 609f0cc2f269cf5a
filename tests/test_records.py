"""Quoted line breaks read by many tasks, against the reader that gives a file to one task."""

import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from wideloom.sources import records as R
from wideloom.sources.csv import parse_csv, read_csv_text


def one_task(spark, path, width, encoding="UTF-8"):
    schema = ", ".join(f"c{i} string" for i in range(width))
    return sorted((tuple(r) for r in spark.read.schema(schema).option("header", True).option("escape", '"').option("multiLine", True)
                   .option("encoding", encoding).csv(path).collect()), key=str)


def messy(seed, rows=400):
    rng = random.Random(seed)
    fields = ['plain', '"quoted"', '"two\nlines"', '"a ""b""\n""c"" d"', '""', '', '5" pipe', '"x,\n\n,y"', ' "late', '"end"x', 'é"', '"\n"',
              '"a\n""\nb"', '"q"" ', '"']
    out = ["h0,h1,h2"]
    for _ in range(rows):
        cells = [rng.choice(fields[:13]) for _ in range(3)]
        out.append(",".join(cells))
        if rng.random() < 0.05:
            out.append("")
    return "\n".join(out) + "\n"


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("block", ["128m", "97", "1k"])
def test_same_rows_as_one_task(spark, tmp_dir, seed, block):
    path = f"{tmp_dir}/m.csv"
    with open(path, "w", newline="") as f:
        f.write(messy(seed))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", block)
    try:
        df = read_csv_text(spark, path)
        got = sorted((tuple(r) for r in df.select([F.nullif(F.col(c), F.lit("")) for c in df.columns]).collect()), key=str)
        tasks = R.tagged_lines(spark, [path], "UTF-8").select("block").distinct().count()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    want = sorted((tuple(None if v == "" else v for v in r) for r in one_task(spark, path, 3)), key=str)
    assert got == want and any("\n" in (v or "") for r in got for v in r)
    assert (tasks > 1) == (block != "128m")


def test_states_of_single_lines(spark):
    cases = {"a,b": (False, True), '"a': (True, False), 'a"b': (False, False), '"a"': (False, True), '"a""': (True, True),
             '","': (False, True), 'x","y': (True, False), '"': (True, False), '""': (False, True), 'x",y,"z': (True, True), '': (False, True)}
    df = spark.createDataFrame([(k,) for k in cases], "line string")
    got = {r.line: (r.o, r.i) for r in df.select("line", R.leaves_open(F.col("line")).alias("o"), R.stays_open(F.col("line")).alias("i")).collect()}
    # begun inside: the first quote closes
    assert {k: v[0] for k, v in got.items()} == {"a,b": False, '"a': True, 'a"b': False, '"a"': False, '"a""': True, '","': False,
                                                 'x","y': True, '"': True, '""': False, 'x",y,"z': True, '': False}
    assert {k: v[1] for k, v in got.items()} == {"a,b": True, '"a': False, 'a"b': False, '"a"': False, '"a""': False, '","': True,
                                                 'x","y': True, '"': False, '""': True, 'x",y,"z': True, '': True}


def test_latin1_records_and_windows_line_ends(spark, tmp_dir):
    path = f"{tmp_dir}/l.csv"
    with open(path, "wb") as f:
        f.write('n,t\r\n1,"caf\u00e9\r\nau lait"\r\n2,x\r\n'.encode("latin-1"))
    df, _ = parse_csv(spark, path)
    assert sorted(map(tuple, df.collect())) == [(1, "café\nau lait"), (2, "x")]


def test_stray_quote_needs_no_records(spark, tmp_dir):
    from wideloom.sources.csv import file_profiles
    path = f"{tmp_dir}/s.csv"
    with open(path, "w") as f:
        f.write('a,b\n5" pipe,x\n6" pipe,"y ""z"""\n')
    assert [p[1] for p in file_profiles(spark, path).values()] == [False]
    assert sorted(map(tuple, read_csv_text(spark, path).collect())) == [('5" pipe', "x"), ('6" pipe', 'y "z"')]


def test_names_that_differ_in_case_are_one_column(spark, tmp_dir):
    import os
    d = f"{tmp_dir}/case"
    os.mkdir(d)
    for name, data in (("a.csv", "Name,n\nx,1\n"), ("b.csv", "NAME , N\ny,2\n")):
        with open(f"{d}/{name}", "w") as f:
            f.write(data)
    df, _ = parse_csv(spark, d)
    assert df.columns == ["Name", "n"] and sorted(map(tuple, df.collect())) == [("x", 1), ("y", 2)]


def shuffled_rows(plan):
    """Rows written by the exchanges of an executed plan."""
    kind, stage = plan.getClass().getSimpleName(), 0
    if kind == "AdaptiveSparkPlanExec":
        return shuffled_rows(plan.executedPlan())
    if kind.endswith("QueryStageExec"):
        return shuffled_rows(plan.plan())
    if kind == "ShuffleExchangeExec":
        stage = plan.metrics().apply("shuffleRecordsWritten").value()
    children = plan.children()
    return stage + sum(shuffled_rows(children.apply(i)) for i in range(children.size()))


def read_with(spark, block, batch, path):
    """Records of a file, cut in blocks and batches of a size, as their fields."""
    conf = {"spark.sql.files.maxPartitionBytes": block, "spark.sql.execution.arrow.maxRecordsPerBatch": batch}
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        got = [r.record for r in R.records(spark, [path], "UTF-8").collect()]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    return sorted(next(csv.reader(io.StringIO(r, newline=""))) for r in got)


def test_text_moves_only_at_the_ends_of_blocks(spark, tmp_dir):
    path = f"{tmp_dir}/long.csv"
    with open(path, "w") as f:
        f.write("n,t\n" + "".join(f'{i},"line one of {i}\nline ""two""\nline three"\n' for i in range(3000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "32k")
    try:
        df = R.records(spark, [path], "UTF-8")
        assert len(df.collect()) == 3000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert shuffled_rows(df._jdf.queryExecution().executedPlan()) < 300          # 9000 lines in about 5 blocks


@pytest.mark.parametrize("rows", ['7,"text\n","en"\n', "7,plain,en\n", '7,"a\n\n\n\n",en\n', '7,"a\n",en\n7,"b",x\n', '7,"x ""y""\n\n"",z\n","\n"\n'])
@pytest.mark.parametrize("block,batch,part", [("61", "3", 9), ("1k", "10000", 16 << 20)])
def test_blocks_that_never_meet_and_records_over_blocks(spark, tmp_dir, monkeypatch, rows, block, batch, part):
    monkeypatch.setattr(R, "PART_BYTES", part)
    path = f"{tmp_dir}/r.csv"
    with open(path, "w") as f:
        f.write('\n  \n"head\n\ner",t,u\n' + rows * 12 + '8,"' + "long\n" * 60 + '",z\n' + rows * 12 + '9,"open\n')
    with open(path, newline="") as f:
        want = [r for r in csv.reader(f) if r and r != ["  "]][1:]
    want[-1][-1] = want[-1][-1].rstrip("\n")                # the last line break is the file's
    assert read_with(spark, block, batch, path) == sorted(want)


def test_small_files_of_one_task_and_blank_files(spark, tmp_dir):
    import os
    d = f"{tmp_dir}/many"
    os.mkdir(d)
    for i in range(6):
        with open(f"{d}/{i}.csv", "w") as f:
            f.write("\n\n" if i == 3 else 'n,t\n' + f'{i},"two\nlines"\n' * i)
    files = [f"{d}/{i}.csv" for i in range(6)]
    got = sorted(r.record for r in R.records(spark, files, "UTF-8").collect())
    assert got == sorted(f'{i},"two\nlines"' for i in (1, 2, 4, 5) for _ in range(i))
