"""The line parser on a streaming file source."""

from __future__ import annotations

from rateweave import schemas
from rateweave.streaming import read_delimited_stream
from tests.conftest import write_dat


def test_new_files_are_parsed_with_rejects(spark, tmp_path):
    folder = write_dat(tmp_path / "in", {"a.dat": ["1::10::5::1000", "2::10::bad::1001", ""]})
    stream = read_delimited_stream(spark, folder, schemas.RATINGS)
    query = (
        stream.writeStream.format("memory")
        .queryName("rw_stream_ratings")
        .option("checkpointLocation", str(tmp_path / "ckpt"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination(120)
    got = spark.sql("SELECT UserID, Rating, _reject FROM rw_stream_ratings ORDER BY UserID").collect()
    assert [tuple(r) for r in got] == [("1", 5.0, None), ("2", None, "bad value: Rating")]


def test_files_per_trigger_limit_still_reads_everything(spark, tmp_path):
    files = {"a.dat": ["1::10::5::1000"], "b.dat": ["2::20::4::1001"], "c.dat": ["3::30::3::1002"]}
    folder = write_dat(tmp_path / "in2", files)
    stream = read_delimited_stream(spark, folder, schemas.RATINGS, max_files_per_trigger=1)
    query = (
        stream.writeStream.format("memory")
        .queryName("rw_stream_limited")
        .option("checkpointLocation", str(tmp_path / "ckpt2"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination(120)
    got = spark.sql("SELECT UserID FROM rw_stream_limited ORDER BY UserID").collect()
    assert [r[0] for r in got] == ["1", "2", "3"]
