import os

from lexiflow.operators import counts
from lexiflow.session import scratch_path
from lexiflow.streaming.incremental import incremental_word_count
from tests.conftest import rows


def test_streaming_count_equals_batch_count(spark):
    path = scratch_path(spark, "stream-src")
    os.makedirs(path)
    texts = ["the cat", "The dog and the cat", "", "a b c the"]
    for i, t in enumerate(texts):
        with open(os.path.join(path, f"f{i}.txt"), "w") as fh:
            fh.write(t + "\n")
    streamed = incremental_word_count(spark, path, max_files_per_trigger=1)
    batch = counts.count_words(spark.read.text(path))
    assert rows(streamed) == rows(batch)
    stops = incremental_word_count(spark, path, lower=True, min_count=2)
    assert rows(stops) == [("the", 4)]


def test_streaming_count_of_empty_folder(spark):
    path = scratch_path(spark, "stream-empty")
    os.makedirs(path)
    with open(os.path.join(path, "empty.txt"), "w"):
        pass
    assert incremental_word_count(spark, path).count() == 0


def test_reading_a_path_that_is_not_there_fails(spark, tmp_path):
    import pytest
    from pyspark.errors import AnalysisException

    from lexiflow.streaming.incremental import read_latest
    with pytest.raises(AnalysisException):
        read_latest(spark, str(tmp_path / "nowhere")).collect()
    (tmp_path / "empty").mkdir()
    assert read_latest(spark, str(tmp_path / "empty")).count() == 0


def test_stream_tables_are_read_by_many_tasks_and_lowered_after_the_explode(spark, tmp_path, monkeypatch):
    import glob

    import pyarrow.parquet as pq
    from pyspark.sql import functions as F

    from lexiflow.plans import catalog  # noqa: F401 (registers the round trips)
    from lexiflow.plans import round_trips
    from lexiflow.streaming.incremental import running_term_frequencies
    texts = spark.range(4800).selectExpr(
        "id AS doc_id", "'s' AS source",
        "array_join(transform(sequence(1, 600), i -> string(pmod(xxhash64(id, i), 9999))), ' ') AS text")
    monkeypatch.setattr(round_trips, "STREAM_ROW_GROUP_BYTES", 1 << 17)
    dealt = round_trips._in_stream_files(texts)
    sizes = [r["n"] for r in dealt.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert dealt.rdd.getNumPartitions() == round_trips.STREAM_FILES and max(sizes) <= 400
    texts.write.parquet(f"{tmp_path}/documents.parquet")
    monkeypatch.setattr(round_trips, "scratch_path", lambda spark, name: f"{tmp_path}/{name}")
    round_trips.streaming_inverted_index_tf(spark, str(tmp_path))
    groups = [pq.ParquetFile(f).num_row_groups for f in glob.glob(f"{tmp_path}/stream-docs/*.parquet")]
    assert sum(groups) > len(groups) > 1
    plan = running_term_frequencies(texts, "text", "source")._jdf.queryExecution().optimizedPlan().toString()
    assert "lower(" in plan and "lambda" not in plan.split("Generate")[1].split("[")[0]


def test_pairs_travel_as_numbers_and_lie_compressed(spark, tmp_path, monkeypatch):
    import glob

    from lexiflow.plans import catalog, round_trips
    pairs = spark.range(2000).selectExpr("id AS doc_a", "id + 1 AS doc_b", "0.875D AS similarity")
    monkeypatch.setattr(catalog, "similar_pairs_prefix", lambda spark, sf_dir: pairs)
    monkeypatch.setattr(round_trips, "scratch_path", lambda spark, name: f"{tmp_path}/{name}")
    back = round_trips.similar_pairs_text(spark, "")
    assert sorted(map(tuple, back.collect())) == [(i, i + 1, "0.875") for i in range(2000)]
    files = glob.glob(f"{tmp_path}/similar_pairs/part-*")
    assert files and all(f.endswith(".gz") for f in files)
