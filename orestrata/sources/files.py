"""Raw CSV scans and the check that their inputs exist."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce
from operator import add

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from orestrata.sources.registry import Dataset, source_path

# Columns that `read_rejecting` adds.
FILE, LINE, REJECTED = "__file", "__line", "__rejected"


def read_csv(
    spark: SparkSession,
    path: str,
    *,
    schema: StructType | str | None = None,
    types: Mapping[str, str] | None = None,
    infer: bool = False,
    multi_line: bool = False,
    seen: Observation | None = None,
) -> DataFrame:
    """CSV with a header row, typed in one of three ways.

    * `schema`: the whole schema; the header must agree with it.
    * `types`: some columns by name, the rest strings. A value that does not fit is NULL.
    * `infer`: Spark guesses every type, at the price of one more pass over the files.

    Of several files, each must have the same columns in the same order; any other header
    is an error when the file is read.

    `seen` counts, while the result is computed, the `rows` read and the `unreadable` values,
    those that `types` turn into NULL.
    """
    # RFC 4180 quoting: a quote inside a quoted field is doubled.
    reader = spark.read.options(header=True, escape='"', multiLine=multi_line)
    if schema is None:
        schema = reader.option("inferSchema", infer).csv(path).schema
    # Every file's header must agree, or columns would be read by position.
    raw = spark.read.options(header=True, escape='"', multiLine=multi_line, enforceSchema=False).schema(schema).csv(path)
    typed = {c: F.col(c).try_cast(types[c]) for c in raw.columns if c in (types or {})}
    if seen is not None:
        lost = [F.count_if(F.col(c).isNotNull() & value.isNull()) for c, value in typed.items()]
        lost = reduce(add, lost, F.count_if(F.lit(False)))
        raw = raw.observe(seen, F.count(F.lit(1)).alias("rows"), lost.alias("unreadable"))
    return raw.withColumns(typed)


def read_rejecting(spark: SparkSession, path: str, *, types: Mapping[str, str] | None = None, multi_line: bool = False) -> DataFrame:
    """CSV typed by name like `read_csv`, with what did not fit beside each row: `__rejected`, an
    array of column, text and reason; where it is not empty, `__file` and `__line`.

    A line with too many or too few fields is one reject without a column; its row keeps the
    fields that are there.
    """
    options = {"header": True, "escape": '"', "multiLine": multi_line}
    schema = spark.read.options(**options).csv(path).schema
    # With a column for them, Spark hands over the text of lines that do not fit the schema.
    reader = spark.read.options(**options, enforceSchema=False, columnNameOfCorruptRecord=LINE)
    raw = reader.schema(StructType([*schema.fields]).add(LINE, "string")).csv(path)
    typed = {c: F.col(c).try_cast(types[c]) for c in schema.names if c in (types or {})}

    def reject(column: str | None, text: str, reason: str) -> Column:
        parts = {"column_name": F.lit(column).cast("string"), "text": F.col(text), "reason": F.lit(reason)}
        return F.struct(*[value.alias(name) for name, value in parts.items()])

    found = [F.when(F.col(LINE).isNotNull(), reject(None, LINE, "wrong number of fields"))]
    found += [F.when(F.col(c).isNotNull() & value.isNull(), reject(c, c, f"not a {types[c]}")) for c, value in typed.items()]
    rejected = F.filter(F.array(*found), lambda r: r.isNotNull())
    line = F.coalesce(LINE, F.to_csv(F.struct(*[F.col(c) for c in schema.names])))
    any_rejected = F.size(REJECTED) > 0
    marked = raw.withColumn(FILE, F.col("_metadata.file_name")).withColumn(REJECTED, rejected)
    marked = marked.withColumns({FILE: F.when(any_rejected, F.col(FILE)), LINE: F.when(any_rejected, line)})
    return marked.withColumns(typed)


def rejects(df: DataFrame) -> DataFrame:
    """One row per value, or line, of `read_rejecting` that did not fit: file, line, column_name,
    text, reason."""
    some = df.filter(F.size(REJECTED) > 0)
    return some.select(F.col(FILE).alias("file"), F.col(LINE).alias("line"), F.inline(REJECTED))


def read_dataset(
    spark: SparkSession, raw_base: str, dataset: Dataset, *, infer: bool = False, seen: Observation | None = None
) -> DataFrame:
    return read_csv(
        spark,
        source_path(raw_base, dataset),
        types=dataset.types,
        infer=infer,
        multi_line=dataset.multi_line,
        seen=seen,
    )


def check_inputs(spark: SparkSession, raw_base: str, datasets: Iterable[Dataset]) -> None:
    """Raise one FileNotFoundError that names every missing input.

    Resolving a text scan looks the path up on whatever file system it names and starts
    no job.
    """
    missing = []
    for dataset in datasets:
        path = source_path(raw_base, dataset)
        try:
            spark.read.text(path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            missing.append(f"{dataset.name}: {path}")
    if missing:
        raise FileNotFoundError("missing input files:\n" + "\n".join(missing))
