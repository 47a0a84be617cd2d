"""``::`` files arriving in a folder, parsed as a Structured Streaming source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from rateweave.sources.delimited import DEFAULT_SEP, parse_lines


def read_delimited_stream(
    spark: SparkSession,
    path: str,
    schema: StructType,
    *,
    sep: str = DEFAULT_SEP,
    mode: str = "permissive",
    trim: bool = True,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """A streaming frame of the typed rows in new files under ``path``.

    Permissive by default: a long-running stream should route a bad line to
    ``_reject`` instead of stopping.
    """
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return parse_lines(reader.load(path), schema, sep=sep, mode=mode, trim=trim)
