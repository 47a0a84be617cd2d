"""Source round trips over data Spark derives from the tables.

Rows are rendered as ``::`` lines (optionally padded with the whitespace the
parser must strip) and parsed back, or written to Parquet in the shared
folder and read back.  Both must reproduce the rows they started from.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rateweave.schemas import DECLARED, conform
from rateweave.session import fresh_path
from rateweave.sources.delimited import DEFAULT_SEP, parse_lines, read_delimited, to_lines
from rateweave.sources.parquet import convert_to_parquet, read_parquet, write_parquet
from rateweave.sources.tables import DAT_FILES


def delimited_roundtrip(df: DataFrame, schema: StructType, *, padding: str = "", mode: str = "strict") -> DataFrame:
    """``df`` → ``::`` lines → parsed under ``schema``.

    With ``padding`` every field is wrapped in it, e.g. ``" \\t"``.
    """
    if not padding:
        lines = to_lines(df, [f.name for f in schema.fields])
    else:
        pad = F.lit(padding)
        fields = [F.concat(pad, F.coalesce(F.col(f.name).cast("string"), F.lit("")), pad) for f in schema.fields]
        lines = df.select(F.concat_ws(DEFAULT_SEP, *fields).alias("value"))
    return parse_lines(lines, schema, mode=mode)


def declared_view(df: DataFrame, schema: StructType) -> DataFrame:
    """``df`` under the declared contract (the typed view of the relation)."""
    return conform(df, schema)


def parquet_roundtrip(spark: SparkSession, df: DataFrame, name: str = "roundtrip") -> DataFrame:
    """Write ``df`` to a fresh folder under the shared folder and read it back."""
    path = write_parquet(df, fresh_path(spark, name))
    return read_parquet(spark, path)


def dat_files(spark: SparkSession, relations: dict[str, DataFrame]) -> str:
    """The relations as folders of ``::`` lines under a fresh base folder, with the dataset's file names.

    A column that a relation lacks is an empty field.
    """
    base = fresh_path(spark, "dat")
    for name, df in relations.items():
        columns = [F.col(f.name) if f.name in df.columns else F.lit("").alias(f.name) for f in DECLARED[name].fields]
        to_lines(df.select(*columns)).write.text(f"{base}/{DAT_FILES[name]}")
    return base


def converted_by_band(spark: SparkSession, relations: dict[str, DataFrame]) -> str:
    """The relations as ``::`` files, users with ages in years, converted to Parquet by age band; returns the folder."""
    out = fresh_path(spark, "converted")
    convert_to_parquet(spark, dat_files(spark, relations), out, raw_ages=True, by_band=True)
    return out


def text_roundtrip(
    spark: SparkSession, listings: list[DataFrame], schema: StructType, name: str = "lines", seq_col: str | None = None
) -> DataFrame:
    """``listings`` written as files of ``::`` lines, one folder each, and read back in file order.

    Folders sort by their number, so a later listing's rows come after an
    earlier one's.  The files go under the shared folder.
    """
    base = fresh_path(spark, name)
    folders = [f"{base}/{n:06d}" for n in range(len(listings))]
    for folder, df in zip(folders, listings):
        to_lines(df, [f.name for f in schema.fields]).write.text(folder)
    return read_delimited(spark, folders, schema, seq_col=seq_col)
