"""Quoted records of several lines against a reader that goes line by line."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from docweave.sources import delimited


def is_open(line, quoted, strict=False):
    """The rules of the dialect, one character at a time."""
    in_field, skip = quoted, False
    for i, c in enumerate(line):
        after = line[i + 1 : i + 2]
        if skip:
            skip = False
            continue
        started = quoted or in_field
        if c == "\\":
            skip = started and after in ('"', "\\") and after != ""
        elif c == '"':
            skip = started and after == '"'
            if not skip:
                quoted = not quoted
            in_field = not in_field
        elif c == "," and not quoted:
            in_field = False
        elif quoted or not strict:
            in_field = True
    return quoted


def plainly(lines, most, strict=False):
    out, i = [], 0
    while i < len(lines):
        j = i + 1
        opened = is_open(lines[i], False, strict)
        while opened and j < len(lines) and j - i <= most:
            opened = is_open(lines[j], True, strict)
            j += 1
        stray = j - i > most or (opened and j < len(lines))
        out.append((i + 1, lines[i], True) if stray else (i + 1, "\n".join(lines[i:j]), False))
        i = i + 1 if stray else j
    return out


def files(seed, n):
    rng = random.Random(seed)
    kinds = ['a,b', 'a,"b', 'c",d', '"x""y",z', 'p\\"q', ',\\"r', '"\\\\",s', '"', '""', '', '\\', 'é,"ü']
    out = {}
    for k in range(n):
        some = rng.sample(kinds, rng.randint(1, len(kinds)))
        out[f"f{k}"] = [rng.choice(some) for _ in range(rng.randint(1, 60))]
    out["one"], out["open"], out["none"] = ['"'], ['"', "x"], []
    return out


def frame(spark, texts):
    rows = [(path, i + 1, line) for path, lines in texts.items() for i, line in enumerate(lines)]
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, "path string, line_no long, line string").repartition(3)


@pytest.mark.parametrize("strict", [False, True])
def test_open_after(spark, strict):
    rng = random.Random(4)
    lines = ["".join(rng.choice('a,"\\ ') for _ in range(rng.randint(0, 9))) for _ in range(600)]
    df = spark.createDataFrame([(x,) for x in lines], "line string")
    got = df.select(*[delimited.open_after(F.col("line"), b, strict_quotes=strict) for b in (False, True)]).collect()
    assert [tuple(r) for r in got] == [(is_open(x, False, strict), is_open(x, True, strict)) for x in lines]


@pytest.mark.parametrize("most,block", [(1, 1), (1, 4), (3, 3), (3, 8), (5, 16), (40, 64)])
def test_records(spark, most, block):
    texts = files(most * 100 + block, 30)
    got = delimited.quoted_records(frame(spark, texts), most=most, block=block).collect()
    want = {(path, *row) for path, lines in texts.items() for row in plainly(lines, most)}
    assert len(got) == len(want) and {(r.path, r.line_no, r.line, r.error is not None) for r in got} == want


def test_records_awkward(spark):
    empty = frame(spark, {"a": ["x"]}).where("false").withColumn("record", F.lit(1)).withColumn("stray", F.lit("s"))
    assert delimited.quoted_records(empty).collect() == []
    with pytest.raises(ValueError):
        delimited.quoted_records(empty, most=9, block=8)
    clash = frame(spark, {"a": ['1,"x', 'y"', "z"]}).withColumn("record", F.lit(1)).withColumn("stray", F.lit("s")).withColumn("block", F.lit(2))
    got = sorted((r.line_no, r.line) for r in delimited.quoted_records(clash).collect())
    assert got == [(1, '1,"x\ny"'), (3, "z")]


def test_stray_quote_costs_one_row_in_a_file_of_many_tasks(spark, tmp_path):
    """A file cut into many splits: records run over their borders."""
    body = [f'{i},"line one of {i}\nline ""two"" of {i}",end' for i in range(3000)]
    body.insert(1000, 'stray,"open' + "\nplain" * 300)
    (tmp_path / "big.csv").write_text("id,text,end\n" + "\n".join(body) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 4
        rows = delimited.read_csv(spark, str(tmp_path), skip=1, multi_line=True).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert [tuple(r.fields) for r in rows if r.error] == [("stray", "open")]
    good = {r.fields[0]: r.fields[1:] for r in rows if not r.error and len(r.fields) == 3}
    assert good == {str(i): [f'line one of {i}\nline "two" of {i}', "end"] for i in range(3000)}
    assert sum(r.fields == ["plain"] for r in rows) == 300 and len(rows) == 3301


def test_skipped_records(spark, tmp_path):
    (tmp_path / "a.csv").write_text('"h\n1",h2\n"a\nb",1\nc,2\nd,3\ne,4\n')
    for skip, want in ((0, 5), (1, 4), (2, 3), (3, 2), (9, 1)):
        rows = delimited.read_csv(spark, str(tmp_path), skip=skip, multi_line=True).orderBy("line_no").collect()
        assert len(rows) == want and (skip < 2) == (len(rows) > 3) and (rows[0].fields[0] == "h\n1") == (skip != 1)
