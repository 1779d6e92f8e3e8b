"""CSV in and out, with one notion of a missing cell and readable errors."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from riskloom.functions.numeric import finite

# Cell texts that count as missing.
MISSING_TEXTS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
    "n/a", "nan", "null",
]

# Patterns, since a failing cast costs an exception per cell.
_WHOLE = r"^\s*[+-]?\d+\s*$"
_DECIMAL = r"^\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|inf|Inf|infinity|Infinity)\s*$"
_TRUTH = ["True", "TRUE", "true", "False", "FALSE", "false"]


class MissingInput(FileNotFoundError):
    """The input is not there; the message says what to run first."""


def require_input(read, path: str, hint: str):
    """Run ``read()``; an absent path becomes a :class:`MissingInput` with a hint."""
    try:
        return read()
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            raise MissingInput(f"File not found: {path}. {hint}") from e
        raise


def blank_to_null(x: Column) -> Column:
    return F.when(~x.isin(MISSING_TEXTS), x)


def quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def _typed(name: str, kind: T.DataType) -> Column:
    text = blank_to_null(quoted(name))
    if isinstance(kind, T.StringType):
        value = text
    elif isinstance(kind, (T.DoubleType, T.FloatType)):
        value = finite(F.trim(text).cast(kind))
    else:
        value = F.trim(text).cast(kind)
    return value.alias(name)


def infer_types(raw: DataFrame) -> T.StructType:
    """Types of all-text columns, found in one scan with one aggregate per column.

    Whole numbers beyond the range of a bigint stay text, so no digit is lost.
    """

    def code(name: str) -> Column:
        text = quoted(name)
        # 1 whole, 2 decimal, 4 truth value, 8 text; the checks stop at the first that fits.
        whole = F.when(F.trim(text).try_cast("bigint").isNotNull(), 1).otherwise(8)
        return (
            F.when(text.isNull() | text.isin(MISSING_TEXTS), F.lit(None).cast("int"))
            .when(text.rlike(_WHOLE), whole)
            .when(text.rlike(_DECIMAL), 2)
            .when(text.isin(_TRUTH), 4)
            .otherwise(8)
        )

    found = raw.agg(*[F.bit_or(code(c)).alias(f"k{i}") for i, c in enumerate(raw.columns)]).first()
    kinds = {1: T.LongType(), None: T.DoubleType(), 2: T.DoubleType(), 3: T.DoubleType(), 4: T.BooleanType()}
    return T.StructType(
        [T.StructField(c, kinds.get(found[f"k{i}"], T.StringType())) for i, c in enumerate(raw.columns)]
    )


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    hint: str = "Check the path.",
    positions: bool = False,
    multi_line: bool = False,
) -> DataFrame:
    """Headed CSV with typed columns and missing texts as NULL; a quote in a quoted cell is doubled.

    With a ``schema`` the file is scanned only when the result is; a cell that
    does not fit its type is an error. Without one, types are found by a scan
    first. ``positions`` keeps the columns :func:`with_row_position` needs.
    ``multi_line`` allows line breaks inside quoted cells; such files are not
    split, so it is off unless asked for.
    """
    raw = require_input(
        lambda: spark.read.csv(path, header=True, escape='"', multiLine=multi_line), path, hint
    )
    kinds = schema or infer_types(raw)
    absent = [f.name for f in kinds if f.name not in raw.columns]
    if absent:
        raise ValueError(f"{path} has no column {', '.join(absent)}")
    columns = [_typed(f.name, f.dataType) for f in kinds]
    if positions:
        columns += [
            F.col("_metadata.file_path").alias("_file"),
            F.col("_metadata.file_block_start").alias("_block"),
            F.monotonically_increasing_id().alias("_local"),
        ]
    return raw.select(*columns)


def write_csv(df: DataFrame, path: str) -> None:
    """Headed CSV part files, without an index column; replaces what is there.

    Quotes are doubled, and blanks around a text are kept.
    """
    df.write.mode("overwrite").csv(
        path, header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    )


def natural_order(name: Column) -> Column:
    """A text that sorts as the name does with its numbers taken as numbers."""
    runs = F.regexp_extract_all(name, F.lit(r"([0-9]+|[^0-9]+)"), F.lit(1))
    padded = F.transform(runs, lambda x: F.when(x.rlike("^[0-9]"), F.lpad(x, 20, "0")).otherwise(x))
    return F.array_join(padded, "")


def with_row_position(df: DataFrame, name: str = "row_position") -> DataFrame:
    """Number rows 0, 1, 2 … in file order, for a ``read_csv(..., positions=True)``.

    Every file block is numbered by its task; only a count per block is
    aggregated to learn where each block starts. Blocks are ordered by file
    name (part 100000 after part 99999) and offset, not by the order in which
    Spark packed them in tasks.
    """
    blocks = df.groupBy("_file", "_block").agg(
        F.min("_local").alias("_first"), F.count(F.lit(1)).alias("_rows")
    )
    before = Window.orderBy(natural_order(F.col("_file")), "_file", "_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.select(
        "_file", "_block", "_first", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start")
    )
    placed = df.join(starts, ["_file", "_block"])
    position = (F.col("_start") + F.col("_local") - F.col("_first")).alias(name)
    kept = [quoted(c) for c in df.columns if c not in ("_file", "_block", "_local")]
    return placed.select(position, *kept)


def join_by_position(left: DataFrame, right: DataFrame, strict: bool = False) -> DataFrame:
    """Rows of two ``read_csv(..., positions=True)`` files put side by side by position.

    Rows beyond the end of the shorter file are kept, the other side is NULL;
    ``strict`` makes a differing number of rows an error.
    """
    if strict and left.count() != right.count():
        raise ValueError("the files have different numbers of rows")
    return with_row_position(left).join(with_row_position(right), "row_position", "full_outer")
