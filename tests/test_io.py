import os

import pytest
from pyspark.sql import functions as F

from lexiflow.session import scratch_path
from lexiflow.sinks.delimited import ARROW, COMMA, TAB, write_delimited, write_scalar
from lexiflow.sources.lines import lines_from_documents, number_lines, read_lines
from lexiflow.sources.side_inputs import (read_processed, read_scalar, read_stop_list,
                                          read_word_counts)
from tests.conftest import rows


def _write_lines(path, name, lines):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w", encoding="utf-8") as fh:
        fh.write("\n".join(lines) + "\n")


def test_word_counts_keep_empty_word_and_skip_malformed(spark):
    path = scratch_path(spark, "wf")
    _write_lines(path, "part-r-00000", [",119671", "0,2", "a,b,3", "zounds,2", "junk", "x,NaN"])
    assert rows(read_word_counts(spark, path)) == [("", 119671), ("0", 2), ("a,b", 3),
                                                   ("zounds", 2)]


def test_stop_list_uses_word_part_only(spark):
    path = scratch_path(spark, "stop")
    _write_lines(path, "stop.txt", ["And,7457", "the,208421", "of", ""])
    assert rows(read_stop_list(spark, path)) == [("And",), ("of",), ("the",)]


def test_processed_and_scalar(spark):
    path = scratch_path(spark, "processed")
    _write_lines(path, "p.txt", ["1,EBook;Complete;Works", "2,Shakespeare;William", "bad", "7"])
    got = {r.doc_id: (list(r.tokens), r.size) for r in read_processed(spark, path).collect()}
    assert got == {1: (["EBook", "Complete", "Works"], 3), 2: (["Shakespeare", "William"], 2)}
    spath = scratch_path(spark, "scalar")
    _write_lines(spath, "count.txt", ["40321"])
    assert read_scalar(spark, spath, "n").first().n == 40321


def test_delimited_sink_layouts_and_modes(spark):
    df = spark.createDataFrame([("b", 2), ("a", 1), ("c", 3)], "word string, n long")
    for sep in (TAB, COMMA, ARROW):
        path = scratch_path(spark, "sink")
        write_delimited(df, path, "word", "n", sep=sep, n_files=1)
        files = [f for f in os.listdir(path) if f.startswith("part-")]
        assert len(files) == 1
        with open(os.path.join(path, files[0]), encoding="utf-8") as fh:
            assert fh.read().splitlines() == [f"a{sep}1", f"b{sep}2", f"c{sep}3"]
        with pytest.raises(Exception):
            write_delimited(df, path, "word", "n", sep=sep)  # output exists: refused
    path = scratch_path(spark, "multi")
    write_delimited(df, path, "word", "n", sep=COMMA, n_files=2)
    assert rows(read_word_counts(spark, path)) == [("a", 1), ("b", 2), ("c", 3)]
    spath = scratch_path(spark, "scalar")
    write_scalar(df.agg(F.count("*").alias("n")), spath)
    write_scalar(df.limit(1).agg(F.count("*").alias("n")), spath, mode="overwrite")
    assert read_scalar(spark, spath).first().value == 1


def test_file_name_tagged_scan_and_dense_ids(spark):
    path = scratch_path(spark, "corpus")
    _write_lines(path, "a.txt", ["﻿first a", "", "second a"])
    _write_lines(path, "b.txt", ["first b", "   ", "third b"])
    tagged = read_lines(spark, path, with_file=True)
    assert sorted(r.doc for r in tagged.collect()) == ["a.txt"] * 3 + ["b.txt"] * 3
    assert "first a" in [r.value for r in tagged.collect()]  # byte-order mark dropped
    numbered = number_lines(spark, path)
    assert rows(numbered, "line_id", "value", "doc") == [
        (1, "first a", "a.txt"), (2, "second a", "a.txt"), (3, "first b", "b.txt"),
        (4, "   ", "b.txt"), (5, "third b", "b.txt")]


def test_lines_from_documents(spark):
    docs = spark.createDataFrame([(7, "x\n\ny z"), (8, "")], "doc_id long, text string")
    out = lines_from_documents(docs)
    assert rows(out, "line_id", "doc_id", "line_no", "value") == [
        (7000001, 7, 1, "x"), (7000002, 7, 2, ""), (7000003, 7, 3, "y z"), (8000001, 8, 1, "")]


def test_dense_ids_across_many_splits(spark):
    """Line ids stay dense and in file order when files are cut into many splits."""
    path = scratch_path(spark, "split-corpus")
    expected = []
    for f in range(3):
        lines = [f"file{f} line {i} " + "x" * (i % 40) for i in range(4000)]
        lines[7] = ""  # empty lines are skipped and use no id
        _write_lines(path, f"part-{f:05d}.txt", lines)
        expected += [(f"part-{f:05d}.txt", v) for v in lines if v != ""]
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(16 * 1024))
    try:
        df = number_lines(spark, path)
        assert df.rdd.getNumPartitions() >= 1
        got = sorted((r.line_id, r.doc, r.value) for r in df.collect())
        n_splits = spark.read.text(path).rdd.getNumPartitions()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert n_splits > 10
    assert [g[0] for g in got] == list(range(1, len(expected) + 1))
    assert [(g[1], g[2]) for g in got] == expected


def test_line_id_stride_guard(spark):
    docs = spark.createDataFrame([(1, "a\nb\nc")], "doc_id long, text string")
    assert [r.line_id for r in lines_from_documents(docs, stride=10).collect()] == [11, 12, 13]
    with pytest.raises(Exception):
        lines_from_documents(docs, stride=3).collect()


def test_multi_file_sink_partitions_by_key_and_sorts(spark):
    df = spark.createDataFrame([(f"w{i:03d}", i) for i in range(200)], "word string, n long")
    path = scratch_path(spark, "k7")
    write_delimited(df.repartition(7), path, "word", "n", sep=COMMA, n_files=5)
    files = sorted(f for f in os.listdir(path) if f.startswith("part-"))
    assert 1 < len(files) <= 5
    seen = []
    for f in files:
        with open(os.path.join(path, f), encoding="utf-8") as fh:
            keys = [line.split(",")[0] for line in fh.read().splitlines()]
        assert keys == sorted(keys)  # sorted inside each file (K8)
        seen += keys
    assert sorted(seen) == sorted(f"w{i:03d}" for i in range(200))  # each key once (K7)


def test_plain_file_names(spark, tmp_path):
    names = ["War and Peace.txt", "a+b.txt", "50%.txt", "été.txt", "x%20y.txt"]
    for n in names:
        (tmp_path / n).write_text(f"in {n}\n")
    from lexiflow.sources.lines import number_lines, read_lines
    for df in (read_lines(spark, str(tmp_path), with_file=True), number_lines(spark, str(tmp_path))):
        assert sorted((r.doc, r.value) for r in df.collect()) == sorted((n, f"in {n}") for n in names)


def test_files_in_name_order_are_one_sequence(spark, tmp_path):
    import glob

    from lexiflow.sinks.delimited import write_delimited
    df = spark.range(5000).selectExpr("(id * 7919) % 5003 AS k", "id AS v")
    write_delimited(df, str(tmp_path / "o"), "k", "v", n_files=6, total_order=True)
    files = sorted(glob.glob(str(tmp_path / "o" / "part-*")))
    keys = [int(line.split("\t")[0]) for f in files for line in open(f)]
    assert len(files) > 1 and keys == sorted(keys) and len(keys) == 5000


def test_lines_of_a_table_end_as_lines_of_a_file(spark, tmp_path):
    from lexiflow.sources.lines import lines_from_documents, read_lines
    text = "a\r\nb\rc\nd"
    (tmp_path / "t.txt").write_bytes(text.encode())
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    want = ["a", "b", "c", "d"]
    assert sorted(r.value for r in read_lines(spark, str(tmp_path / "t.txt")).collect()) == want
    assert [r.value for r in lines_from_documents(docs).orderBy("line_no").collect()] == want


def test_stage_tables_are_dropped_on_request(spark):
    import os

    from lexiflow.session import drop_stage_tables, materialize, scratch_path
    materialize(spark.range(3), "gone")
    unused = scratch_path(spark, "never-written")
    assert drop_stage_tables(spark) >= 1 and not os.path.exists(unused)
    assert drop_stage_tables(spark) == 0


def test_line_numbers_need_no_window_over_all_blocks(spark, tmp_path):
    from lexiflow.sources.lines import number_lines
    for i in range(40):
        (tmp_path / f"f{i:02}.txt").write_text("".join(f"{i} {j}\n\n" for j in range(i % 5)))
    got = sorted(number_lines(spark, str(tmp_path)).collect(), key=lambda r: r.line_id)
    assert [r.line_id for r in got] == list(range(1, len(got) + 1))
    assert [(r.doc, r.value) for r in got] == [(f"f{i:02}.txt", f"{i} {j}") for i in range(40) for j in range(i % 5)]
    # every window of the rank and prefix sums has a partition key
    from lexiflow.operators import ranks
    counts = spark.range(600).select(F.col("id").alias("k"), F.lit(2).alias("v"))
    plan = ranks.prefix_sums(counts, "k", "v", 599)._jdf.queryExecution().executedPlan().toString()
    assert "windowspecdefinition(_range" in plan and "SinglePartition" not in plan
