"""Reading text files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opinarium.functions import fixed_values as fixed
from opinarium.operators.indexing import with_row_index

BAD_LINE = "_bad_line"

LABEL_FIRST = T.StructType(
    [
        T.StructField("label", T.IntegerType()),
        T.StructField("text_a", T.StringType()),
    ]
)

ID_NAME = T.StructType(
    [T.StructField("id", T.LongType()), T.StructField("name", T.StringType())]
)

KEYWORD_SHEET = T.StructType(
    [
        T.StructField("row_order", T.IntegerType()),
        T.StructField(fixed.SHEET_NAME_COLUMN, T.StringType()),
    ]
    + [T.StructField(c, T.StringType()) for c in fixed.SHEET_KEYWORD_COLUMNS]
)


def unescaped(column: Column) -> Column:
    r"""Undo `escaped` of the writers: `\n`, `\r` and `\\` in a text become what they stand for."""
    # a NUL cannot stand next to a backslash in what the writers make
    kept = F.replace(column, F.lit("\\\\"), F.lit("\\\0"))
    lines = F.replace(F.replace(kept, F.lit("\\n"), F.lit("\n")), F.lit("\\r"), F.lit("\r"))
    return F.replace(lines, F.lit("\\\0"), F.lit("\\"))


def _restored(df: DataFrame) -> DataFrame:
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: unescaped(F.col(c)) for c in texts})


def _read(
    spark: SparkSession, path: str, schema: T.StructType, sep: str, multiline: bool
) -> DataFrame:
    rows = spark.read.csv(
        path,
        schema=schema,
        sep=sep,
        header=True,
        quote='"',
        escape='"',
        multiLine=multiline,
        enforceSchema=True,
    )
    return rows if multiline else _restored(rows)


def read_tsv(
    spark: SparkSession, path: str, schema: T.StructType, multiline: bool = False
) -> DataFrame:
    """Tab-separated file with a header, a row per line, which splits at any size.

    Line ends inside a text are escaped, as the writers here do. `multiline=True` reads
    files of others with bare line ends inside quotes, each file as one task.
    """
    return _read(spark, path, schema, "\t", multiline)


def read_label_first(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """`label<TAB>text` lines under a header, unquoted: (good rows, rejected lines).

    A line is rejected unless it has exactly two fields and an integer label.
    """
    schema = T.StructType(
        LABEL_FIRST.fields + [T.StructField(BAD_LINE, T.StringType())]
    )
    rows = spark.read.csv(
        path,
        schema=schema,
        sep="\t",
        header=True,
        quote="",
        mode="PERMISSIVE",
        columnNameOfCorruptRecord=BAD_LINE,
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    )
    # all columns are named, so that Spark fills the bad-line column
    whole = F.col(BAD_LINE).isNull() & F.col("label").isNotNull()
    good = rows.where(whole).select("label", "text_a")
    rejected = rows.where(~whole).select("label", "text_a", BAD_LINE)
    return good, rejected


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType, multiline: bool = False
) -> DataFrame:
    """The same with commas; a leading byte-order mark does no harm."""
    return _read(spark, path, schema, ",", multiline)


def read_keyword_sheet(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """The keyword sheet as CSV; missing cells become empty text."""
    return _read(spark, path, KEYWORD_SHEET, ",", multiline).fillna("")


def read_delimited(
    spark: SparkSession, path: str, schema: T.StructType = ID_NAME, sep: str = "\u0001"
) -> DataFrame:
    r"""Plain delimited lines without header or quoting; `path` may be a glob.

    `\N` is NULL and an empty field is empty text, which the CSV reader cannot
    tell apart.
    """
    cells = F.split(F.col("value"), f"\\Q{sep}\\E", -1)

    def cell(i: int, field: T.StructField):
        raw = F.get(cells, F.lit(i))
        return F.when(raw != "\\N", raw).cast(field.dataType).alias(field.name)

    return spark.read.text(path).select(*[cell(i, f) for i, f in enumerate(schema.fields)])


def read_vocabulary(spark: SparkSession, path: str) -> DataFrame:
    """(token, id) from one-token-per-line files; id = line number, files in name order.

    The line number follows from the file, the offset of the split and the
    order inside it, so big files are read in parallel.
    """
    lines = spark.read.text(path).select(
        F.trim(F.col("value")).alias("token"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
    )
    indexed = with_row_index(lines, ["file", "block", "line"], "id")
    return indexed.select("token", "id")
