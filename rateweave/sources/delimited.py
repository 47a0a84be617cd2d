"""Delimited text: one record per line, ``::`` between fields, no quoting.

The line scan is Spark's splittable text source; splitting, trimming and
casting are Spark expressions, so parsing runs inside whole-stage codegen.

Two modes, because the source data is hand-made and can be dirty:

* ``strict``: a short line, a blank line or a value that does not cast fails
  the job (the reference program failed too, with an index or number error).
* ``permissive``: blank lines are dropped; every other bad line is kept with
  NULLs, a reason in ``_reject`` and its raw text in ``_line``;
  ``accepted``/``rejected`` split them.

Either way, extra fields are ignored and a trailing empty field is kept as
``''`` (the JVM's ``split`` would have dropped it and then failed).
"""

from __future__ import annotations

import codecs

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from rateweave.functions.strings import jvm_trim, trim_common, trim_rest

DEFAULT_SEP = "::"
REJECT = "_reject"
RAW_LINE = "_line"


def read_lines(spark: SparkSession, path: str | list[str], encoding: str = "utf-8", seq_col: str | None = None) -> DataFrame:
    """Lines of the files under ``path`` as ``value``.

    ``seq_col`` adds each line's position in file order (file path, split
    start, then position inside the split), for last-one-wins dimensions.
    The text source finds lines by their bytes, so it serves every encoding
    of one byte a character alike: the bytes are read as ISO-8859-1 and
    those above ASCII mapped to the encoding's characters.
    """
    lines = spark.read.text(path)
    if codecs.lookup(encoding).name != "utf-8":
        lines = lines.withColumn("value", _single_byte(F.col("value"), encoding))
    if seq_col is None:
        return lines
    position = F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )
    return lines.select("value", position.alias(seq_col))


def _single_byte(raw: Column, encoding: str) -> Column:
    """Raw bytes decoded by an encoding of one byte a character.  A byte that
    stands for nothing becomes U+FFFD."""
    if b"".join(chr(c).encode(encoding, "replace") for c in range(128)) != bytes(range(128)):
        raise ValueError(f"{encoding} is not an extension of ASCII by single bytes; convert the files to UTF-8")
    upper = [bytes([b]).decode(encoding, "replace") for b in range(128, 256)]
    pairs = [bytes([b, c]).decode(encoding, "replace") for b in range(128, 256) for c in (0x40, 0xA1)]
    if any(len(c) != 1 for c in upper) or any(len(c) != 2 for c in pairs):
        raise ValueError(f"{encoding} is not an encoding of one byte a character; convert the files to UTF-8")
    text = F.decode(raw.cast("binary"), "ISO-8859-1")
    changed = [(chr(b), c) for b, c in zip(range(128, 256), upper) if chr(b) != c]
    if not changed:
        return text
    return F.translate(text, "".join(a for a, _ in changed), "".join(c for _, c in changed))


def parse_lines(
    lines: DataFrame,
    schema: StructType,
    *,
    sep: str = DEFAULT_SEP,
    mode: str = "strict",
    trim: bool = True,
    value_col: str = "value",
) -> DataFrame:
    """Typed columns of ``schema`` from the delimited ``value`` column.

    Columns of ``lines`` other than ``value_col`` are carried through.  The
    work is staged (split, then trim each field in two steps, then cast each
    field, then check) so that every step runs once per field, not once per use.
    """
    if mode not in ("strict", "permissive"):
        raise ValueError(f"unknown mode {mode!r}")
    width = len(schema.fields)
    carried = [c for c in lines.columns if c != value_col]
    line = F.col(value_col)
    staged = lines.select(*carried, line.alias("_line"), split_literal(line, sep).alias("_parts"))
    if mode == "permissive":
        staged = staged.where(F.col("_line").isNull() | (jvm_trim(F.col("_line")) != F.lit("")))

    fields = []
    for i in range(width):
        raw = F.get(F.col("_parts"), i)
        fields.append((trim_common(raw) if trim else raw).alias(f"_f{i}"))
    short = F.col("_line").isNull() | (F.size(F.col("_parts")) < F.lit(width))
    staged = staged.select(*carried, "_line", short.alias("_short"), *fields)
    if trim:
        rest = [trim_rest(F.col(f"_f{i}")).alias(f"_f{i}") for i in range(width)]
        staged = staged.select(*carried, "_line", "_short", *rest)

    casts = []
    for i, field in enumerate(schema.fields):
        text = F.col(f"_f{i}")
        value = text if isinstance(field.dataType, StringType) else text.try_cast(field.dataType)
        casts.append(value.alias(f"_v{i}"))
    staged = staged.select(*carried, "_line", "_short", *[f"_f{i}" for i in range(width)], *casts)

    short = F.col("_short")
    typed, bad_casts = [], []
    for i, field in enumerate(schema.fields):
        value = F.col(f"_v{i}")
        failed = F.col(f"_f{i}").isNotNull() & value.isNull()
        text_field = isinstance(field.dataType, StringType)
        if mode == "strict":
            checked = F.when(short, _fail(f"expected {width} fields"))
            if not text_field:
                checked = checked.when(failed, _fail(f"field {field.name} is not a {field.dataType.simpleString()}"))
            value = checked.otherwise(value)
        elif not text_field:
            bad_casts.append(F.when(failed, F.lit(field.name)))
        typed.append(value.alias(field.name))

    if mode == "strict":
        return staged.select(*carried, *typed)
    reason = F.when(short, F.lit(f"expected {width} fields"))
    if bad_casts:
        listed = F.concat_ws(",", *bad_casts)
        reason = reason.when(listed != F.lit(""), F.concat(F.lit("bad value: "), listed))
    return staged.select(*carried, *typed, reason.alias(REJECT), F.when(reason.isNotNull(), F.col("_line")).alias(RAW_LINE))


# A separator of several characters makes ``split`` compile its regular
# expression for every row.  Swapping it for one control character first
# lets the single-character fast path split without a regex; a line that
# already holds that character takes the regex route.
_STAND_IN = "\u0001"


def split_literal(line: Column, sep: str) -> Column:
    """``line`` split on the literal ``sep``, keeping trailing empty fields."""
    by_regex = F.split(line, "\\Q" + sep + "\\E", -1)
    if len(sep) == 1 or _STAND_IN in sep:
        return by_regex
    by_char = F.split(F.replace(line, F.lit(sep), F.lit(_STAND_IN)), _STAND_IN, -1)
    return F.when(F.instr(line, _STAND_IN) == 0, by_char).otherwise(by_regex)


def _fail(what: str) -> Column:
    line = F.coalesce(F.col("_line"), F.lit("<no line>"))
    return F.raise_error(F.concat(F.lit(f"malformed line ({what}): "), line))


def accepted(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col(REJECT).isNull()).drop(REJECT, RAW_LINE)


def rejected(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col(REJECT).isNotNull())


def read_delimited(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType,
    *,
    sep: str = DEFAULT_SEP,
    mode: str = "strict",
    trim: bool = True,
    encoding: str = "utf-8",
    seq_col: str | None = None,
) -> DataFrame:
    """Scan + split + schema in one step (strict rows, or permissive rows with ``_reject``)."""
    lines = read_lines(spark, path, encoding=encoding, seq_col=seq_col)
    return parse_lines(lines, schema, sep=sep, mode=mode, trim=trim)


def to_lines(df: DataFrame, columns: list[str] | None = None, sep: str = DEFAULT_SEP) -> DataFrame:
    """Render rows as delimited lines in ``value`` (the inverse of the parser)."""
    columns = columns or df.columns
    fields = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]
    return df.select(F.concat_ws(sep, *fields).alias("value"))
