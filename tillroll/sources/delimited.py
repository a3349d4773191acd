"""Retail lines as delimited text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.functions import infer
from tillroll.functions.sheet import timestamp_text
from tillroll.schemas import RAW_LINES
from tillroll.sources.staging import staged

# One dialect both ways: a quote inside a field is doubled.
_FIRST_ROWS = 1_000  # looked at first, to know which columns are text
_DIALECT = {"header": True, "quote": '"', "escape": '"'}


def read_lines(
    spark: SparkSession, path: str, schema: T.StructType = RAW_LINES, multi_line: bool = False
) -> DataFrame:
    """Scan with an explicit schema: no pass over the data before the query.

    The header is skipped and the schema applied by position; a field that does
    not parse is null. Fields with line breaks need `multi_line=True`, which
    gives up splitting a file over tasks, so it is off unless asked for.
    """
    return spark.read.options(**_DIALECT, multiLine=multi_line).schema(schema).csv(path)


def read_lines_inferred(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Scan with names from the header and types from the data: one extra full pass."""
    return spark.read.options(**_DIALECT, multiLine=multi_line, inferSchema=True).csv(path)


def read_lines_once(
    spark: SparkSession, path: str, multi_line: bool = False, name: str = "lines-text"
) -> DataFrame:
    """As `read_lines_inferred`, but the input is parsed once.

    The fields are staged as text columns in one scan; the types come from an aggregate
    over those columns, and the values from casting them. What reads the result reads
    columns, so only those it needs. A whole number in exponent form counts as a double,
    where Spark's own inference makes it a decimal of negative scale.
    """
    header = spark.read.options(**_DIALECT, multiLine=multi_line).csv(path).columns
    texts = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(header))])
    parsed = spark.read.options(**_DIALECT, multiLine=multi_line, enforceSchema=True).schema(texts).csv(path)
    table = staged(parsed, name)

    # A column with a text among its first rows is text whatever follows; only the others are looked at in full,
    # each by an aggregate of its own: it reads its column alone, and all together would be too much code to compile.
    first = table.limit(_FIRST_ROWS).agg(*(infer.kinds_of(F.col(c)).alias(c) for c in texts.names))
    found = first.first().asDict() if header else {}
    for c in [c for c in texts.names if not infer.is_settled(found[c])]:
        found[c] = table.agg(infer.kinds_of(F.col(c))).first()[0]
    wide = [c for c in texts.names if infer.type_of(found[c]).startswith("decimal")]
    digits = table.agg(*(infer.digits_of(F.col(c)).alias(c) for c in wide)).first().asDict() if wide else {}
    kinds = [infer.type_of(found[c], digits.get(c)) for c in texts.names]
    return table.select(*(infer.typed(F.col(c), k).alias(n) for c, k, n in zip(texts.names, kinds, header)))


def read_lines_checked(
    spark: SparkSession, path: str, schema: T.StructType = RAW_LINES, multi_line: bool = False, name: str = "lines-checked"
) -> tuple[DataFrame, DataFrame]:
    """The rows of `read_lines`, and the lines behind those that did not parse as a whole.

    The second table has `file, line, columns`: the line as it stands in the file and the
    columns of `schema` in which it has text but no value; `columns` is empty where the
    line has too few or too many fields. The input is parsed once, into a staged table
    partitioned by whether a line is whole.
    """
    corrupt = "corrupt_line"
    while corrupt in schema.names:
        corrupt += "_"
    wide = T.StructType([*schema.fields, T.StructField(corrupt, T.StringType())])
    reader = spark.read.options(**_DIALECT, multiLine=multi_line, columnNameOfCorruptRecord=corrupt)
    scan = reader.schema(wide).csv(path).withColumns(
        {"rejected_file": F.col("_metadata.file_path"), "rejected": F.col(corrupt).isNotNull()}
    )
    table = staged(scan, name, "rejected")
    texts = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    fields = F.from_csv(corrupt, _ddl(texts), {"quote": '"', "escape": '"'})
    rejects = table.filter("rejected").withColumn("rejected_fields", fields)
    failed = [
        F.when(rejects["rejected_fields"].getField(f.name).isNotNull() & F.col(f"`{f.name}`").isNull(), F.lit(f.name))
        for f in schema.fields
    ]
    columns = F.array_compact(F.array(*failed))
    return (
        table.select(*(f"`{n}`" for n in schema.names)),
        rejects.select(F.col("rejected_file").alias("file"), F.col(corrupt).alias("line"), columns.alias("columns")),
    )


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def write_lines(df: DataFrame, path: str, line_breaks: bool = False) -> None:
    """Write a folder of UTF-8 parts, each with a header.

    Date-times are written as `yyyy-MM-dd`, with the time only if it is not
    midnight. Blanks around a text are kept. An empty text and a null are both
    written as nothing, so both come back as null. A line break inside a field fails
    the job unless `line_breaks` allows it, as only `multi_line=True` can read it back.
    """
    times = {
        f.name: timestamp_text(F.col(f"`{f.name}`"))
        for f in df.schema.fields
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType))
    }
    problem = F.raise_error(F.lit("Line break inside a field; allow it with line_breaks=True")).cast("string")
    texts = {
        f.name: F.when(F.col(f"`{f.name}`").rlike("[\\r\\n]"), problem).otherwise(F.col(f"`{f.name}`"))
        for f in df.schema.fields
        if isinstance(f.dataType, T.StringType) and not line_breaks
    }
    df.withColumns(times | texts).write.options(
        **_DIALECT,
        emptyValue="",
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
        encoding="UTF-8",
    ).csv(path)
