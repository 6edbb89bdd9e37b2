"""Comment and result files."""

from __future__ import annotations

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamReader
from pyspark.sql.types import StringType, StructField, StructType

from recado.functions.text import text_key
from recado.operators.comments import with_ids

COMMENT_SCHEMA = ("comment_id bigint, interaction_date string, user_name string, url string, "
                  "content_type string, text string")

RESULT_COLUMNS = ("interaction_date", "user_name", "url", "content_type", "original_text", "cluster", "sentimento",
                  "problema", "problema_30d", "order_number")

RESULT_SCHEMA = "interaction_date date, " + ", ".join(f"{c} string" for c in RESULT_COLUMNS[1:])

# The three forms in which comment files arrive.
DIALECTS = {
    "train": {"sep": ",", "quote": '"', "escape": '"'},
    "infer": {"sep": ";", "quote": '"', "escape": "\\"},
    "replay": {"sep": ";", "quote": '"', "escape": '"'},
}

# Comments hold line breaks, so a file is one task: deliver many files rather than one large one.
CSV_OPTIONS = {"header": "true", "multiLine": "true", "ignoreLeadingWhiteSpace": "false",
               "ignoreTrailingWhiteSpace": "false"}


REQUIRED = ("interaction_date", "user_name", "url", "text")
BAD_RECORD = "_bad_record"


def file_schema(spark: SparkSession, path: str, dialect: str = "infer") -> StructType:
    """Columns that comment files name in their header, as text, and one for records that do not fit it.

    Files are read by these names: they may hold `COMMENT_SCHEMA` in any order, without an id or a content type, and
    further columns. A header without one of the `REQUIRED` columns ends the run.
    """
    names = spark.read.options(**CSV_OPTIONS, **DIALECTS[dialect]).csv(path).columns
    missing = [c for c in REQUIRED if c not in names]
    if missing:
        raise ValueError(f"comment files at {path} lack the columns {missing}; their header is {names}")
    return StructType([StructField(n, StringType()) for n in [*names, BAD_RECORD]])


def _raw(reader: DataFrameReader | DataStreamReader, schema: StructType, dialect: str) -> DataFrameReader | DataStreamReader:
    """Every file's header is held against the schema; another order or other names end the run."""
    return reader.schema(schema).options(**CSV_OPTIONS, **DIALECTS[dialect], enforceSchema="false", columnNameOfCorruptRecord=BAD_RECORD)


def as_comments(raw: DataFrame) -> DataFrame:
    """Good records as `COMMENT_SCHEMA`; rows without a usable id get a derived one."""
    good = raw.where(F.col(BAD_RECORD).isNull())
    wanted = {name: kind for name, kind in (c.split(" ") for c in COMMENT_SCHEMA.split(", "))}
    return with_ids(good.select(*[(F.col(n).try_cast(k) if n in raw.columns else F.lit(None).cast(k)).alias(n) for n, k in wanted.items()]))


def read_comments(spark: SparkSession, path: str, dialect: str = "infer") -> DataFrame:
    """Comments of the files at ``path``. A file is one task, as comments hold line breaks: deliver many files."""
    return as_comments(_raw(spark.read, file_schema(spark, path, dialect), dialect).csv(path))


def read_bad_records(spark: SparkSession, path: str, dialect: str = "infer") -> DataFrame:
    """Records that do not fit their file's header, whole, in ``_bad_record``, with what could be read of them."""
    return _raw(spark.read, file_schema(spark, path, dialect), dialect).csv(path).where(F.col(BAD_RECORD).isNotNull())


def stream_comments(spark: SparkSession, path: str, dialect: str = "infer", files_per_batch: int = 100) -> DataFrame:
    """Files as they arrive, as raw columns (`as_comments` makes comments of them). One file at least must be there for the header."""
    schema = file_schema(spark, path, dialect)
    return _raw(spark.readStream, schema, dialect).option("maxFilesPerTrigger", files_per_batch).csv(path)


def write_comments(df: DataFrame, path: str, dialect: str = "infer") -> None:
    df.write.options(**CSV_OPTIONS, **DIALECTS[dialect]).csv(path)


def write_results(df: DataFrame, path: str, fmt: str = "parquet", sort: bool = False) -> None:
    """Results in column order; as CSV every field is quoted. ``sort`` orders the files by date, and within
    a date by user and text, so that a busy day can be cut into several files."""
    df = df.select(*RESULT_COLUMNS)
    if sort:
        df = df.orderBy("interaction_date", "user_name", text_key(F.col("original_text")))
    if fmt == "csv":
        df.write.options(**CSV_OPTIONS, **DIALECTS["train"], quoteAll="true").csv(path)
    else:
        df.write.format(fmt).save(path)


def read_results(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    if fmt == "csv":
        return spark.read.schema(RESULT_SCHEMA).options(**CSV_OPTIONS, **DIALECTS["train"]).csv(path)
    return spark.read.format(fmt).load(path)
