"""The cleaning pipeline as an incremental file stream."""

import os
import shutil
import tempfile

from roadframe.plans import catalog
from roadframe.sources.fixture import landed_fixture_path
from roadframe.streaming.ingest import start_clean_ingest


def test_stream_equals_batch(spark, sf_dir):
    streamed = catalog.QUERIES["clean_stream"](spark, sf_dir)
    batch = catalog.QUERIES["clean_pipeline"](spark, sf_dir)
    assert sorted(streamed.collect()) == sorted(batch.collect())


def test_stream_picks_up_only_new_files(spark, sf_dir):
    src = landed_fixture_path(spark, sf_dir, "csv")
    src = src[len("file:"):] if src.startswith("file:") else src
    parts = sorted(f for f in os.listdir(src) if f.endswith(".csv"))
    work = tempfile.mkdtemp(prefix="stream-src-")
    sink, ckpt = tempfile.mkdtemp(prefix="stream-sink-"), tempfile.mkdtemp(prefix="stream-ckpt-")
    half = len(parts) // 2 or 1
    for f in parts[:half]:
        shutil.copy(os.path.join(src, f), work)
    q = start_clean_ingest(spark, work, sink, ckpt)
    q.awaitTermination()
    first = spark.read.parquet(sink).count()
    for f in parts[half:]:
        shutil.copy(os.path.join(src, f), work)
    q = start_clean_ingest(spark, work, sink, ckpt)  # restart from the checkpoint
    q.awaitTermination()
    total = spark.read.parquet(sink).count()
    assert total == catalog.QUERIES["clean_pipeline"](spark, sf_dir).count()
    assert 0 < first <= total


def test_stream_in_several_micro_batches(spark, sf_dir):
    from roadframe.streaming.ingest import clean_stream
    src = landed_fixture_path(spark, sf_dir, "csv")
    sink, ckpt = tempfile.mkdtemp(prefix="stream-mb-"), tempfile.mkdtemp(prefix="stream-mb-ckpt-")
    q = (clean_stream(spark, src, max_files_per_trigger=2).writeStream.format("parquet")
         .option("path", sink).option("checkpointLocation", ckpt).trigger(availableNow=True).start())
    q.awaitTermination()
    batches = [p for p in q.recentProgress if p["numInputRows"] > 0]
    assert len(batches) >= 2
    got = sorted(spark.read.parquet(sink).collect())
    assert got == sorted(catalog.QUERIES["clean_pipeline"](spark, sf_dir).collect())
