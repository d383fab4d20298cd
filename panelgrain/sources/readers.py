"""File, step, fact and lookup reads (SRC-*)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelgrain.operators.layouts import FACT_TAGS, FACT_WIDTH
from panelgrain.spec import PERIOD_CLASSES

# Vendor formats, how they are delimited, and header words of one of them.
COMMA_FORMATS = ("SFF3",)
PIPE_FORMATS = ("SFF", "SFF2")
TEXT_FORMATS = ("FFS", "FFS2", "Tape2", "Tape3")
SFF3_WORDS = {"market_code": "market_id", "product_code": "product_id", "period_code": "period_id"}


def read_raw(spark: SparkSession, path: str, vendor_format: str) -> DataFrame:
    """Headered delimited files as strings, fixed-width files as text lines; other formats are refused."""
    if vendor_format in COMMA_FORMATS + PIPE_FORMATS:
        sep = "," if vendor_format in COMMA_FORMATS else "|"
        return spark.read.csv(path, header=True, sep=sep)
    if vendor_format in TEXT_FORMATS:
        return spark.read.text(path)
    raise ValueError(f"unknown vendor format {vendor_format!r}")


def wide_schema(width: int = FACT_WIDTH) -> T.StructType:
    return T.StructType([T.StructField(f"col{i}", T.StringType()) for i in range(1, width + 1)])


def read_wide_facts(spark: SparkSession, path: str, vendor_format: str) -> DataFrame:
    """Headerless wide facts; the comma format's header words become the tags used downstream.

    A line with more columns than facts have is kept whole in `surplus`, which is null for all others.
    """
    if vendor_format not in COMMA_FORMATS + PIPE_FORMATS:
        raise ValueError(f"unknown vendor format {vendor_format!r}")
    sep = "|" if vendor_format in PIPE_FORMATS else ","
    shape = wide_schema()
    reader = spark.read.schema(T.StructType([*shape.fields, T.StructField("surplus", T.StringType())]))
    # With pruned columns the parser would not look at the end of a line.
    raw = reader.options(sep=sep, columnNameOfCorruptRecord="surplus", columnPruning=False).csv(path)
    # Lines that are too short are set apart as well; only long ones are a surplus.
    raw = raw.withColumn("surplus", F.when(F.size(F.split("surplus", "[|]" if sep == "|" else sep)) > len(shape), F.col("surplus")))
    if vendor_format in PIPE_FORMATS:
        return raw
    words = zip(("col1", "col2", "col3"), SFF3_WORDS.values(), FACT_TAGS.values())
    return raw.withColumns({c: F.regexp_replace(c, word, tag) for c, word, tag in words})


def read_delimited(spark: SparkSession, path: str, delimiter: str) -> DataFrame:
    """A tier 2 delivery file: every column a string, nothing inferred."""
    return spark.read.csv(path, header=True, sep=delimiter)


SETTINGS = ("file_pattern", "step_pattern", "delimiter")


def contract_settings(contracts: DataFrame, delimiters: DataFrame) -> DataFrame:
    """File pattern, step pattern and delimiter per contract, with a list of what is missing."""
    absent = F.concat_ws(", ", *[F.when(F.coalesce(F.col(s), F.lit("")) == "", s) for s in SETTINGS])
    return contracts.join(delimiters, "delimiter_id", "left").select("contract_id", *SETTINGS, absent.alias("missing"))


def load_settings(contracts: DataFrame, delimiters: DataFrame, contract_id: int) -> dict[str, str]:
    """Settings of one contract; one error lists all that is missing."""
    row = contract_settings(contracts, delimiters).where(F.col("contract_id") == contract_id).head()
    missing = row.missing if row else ", ".join(SETTINGS)
    if missing:
        raise ValueError(f"contract {contract_id} has no {missing}")
    return {s: row[s] for s in SETTINGS}


def files_like(files: DataFrame, glob: str, name: str = "name") -> DataFrame:
    """Listing rows whose file name matches a glob, ignoring case."""
    escaped = "".join({"*": ".*", "?": "."}.get(c, "\\" + c if not c.isalnum() else c) for c in glob)
    return files.where(F.col(name).rlike(f"(?is)^{escaped}$"))


def choose_file(files: DataFrame, glob: str, name: str = "name") -> str:
    """The one file that matches; none or several is an error. Reads two rows at most."""
    rows = files_like(files, glob, name).select(name).take(2)
    if len(rows) != 1:
        raise ValueError(f"{'no file' if not rows else 'more than one file'} matches {glob!r}")
    return rows[0][0]


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """File listing of a folder as rows; contents are not read because the column is pruned."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    return files.select("path", F.element_at(F.split("path", "/"), -1).alias("name"), F.col("length").alias("size"), "modificationTime")


def read_step(spark: SparkSession, path: str) -> DataFrame | None:
    """Parquet of an earlier step, or None when the step left nothing."""
    try:
        return spark.read.parquet(path)
    except Exception as error:
        if "PATH_NOT_FOUND" in str(error):
            return None
        raise


def jdbc_options(url: str, *, table: str | None = None, query: str | None = None, partition: Mapping[str, object] | None = None, **more) -> dict[str, str]:
    """Options of a table or query read. A table read may name a partition column with bounds, so a
    large lookup is not pulled through one connection."""
    if (table is None) == (query is None):
        raise ValueError("name a table or a query")
    if query is not None and partition:
        raise ValueError("a query read cannot be partitioned; read a table instead")
    options = {"url": url, **({"dbtable": table} if table else {"query": query}), **more}
    if partition:
        names = ("partitionColumn", "lowerBound", "upperBound", "numPartitions")
        options |= {n: str(partition[n]) for n in names}
    return {k: str(v) for k, v in options.items()}


def read_jdbc(spark: SparkSession, url: str, **options) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_options(url, **options)).load()


def read_query(spark: SparkSession, text: str, params: Mapping[str, object], **frames: DataFrame) -> DataFrame:
    """SQL over DataFrames with bound markers; values are never spliced into the text."""
    return spark.sql(text, args=dict(params), **frames)


def period_class(name: str) -> str:
    """One of the five legal classes, lower case, else an error."""
    if name is None or name.lower() not in PERIOD_CLASSES:
        raise ValueError(f"unknown period class {name!r}")
    return name.lower()


def read_fact(spark: SparkSession, base: str, name: str, source_id: int, contract_id: int) -> DataFrame:
    """Facts of one class, pruned to the source system's and contract's partitions."""
    facts = spark.read.parquet(f"{base}/fact_{period_class(name)}")
    return facts.where((F.col("part_source_id") == source_id) & (F.col("part_contract_id") == contract_id))


def read_commit_log(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)


def read_any(
    spark: SparkSession, kind: str, path: str, schema: T.StructType | None = None, options: Mapping[str, str] | None = None
) -> DataFrame:
    """Configured read of any file format Spark knows."""
    reader = spark.read.format(kind).options(**dict(options or {}))
    return (reader.schema(schema) if schema is not None else reader).load(path)


# ---------------------------------------------------------------- lookups


def contract_lookup(
    contracts: DataFrame, categories: DataFrame, countries: DataFrame, extra: Sequence[str] = ()
) -> DataFrame:
    """Contract with its categories and country."""
    return contracts.join(categories, "contract_id").join(countries, "country").select(
        "contract_id", "category", "country", "country_name", *extra
    )


def rows_of(lookup: DataFrame, **equals) -> DataFrame:
    """Lookup rows where every named column has the given value."""
    out = lookup
    for name, value in equals.items():
        out = out.where(F.col(name) == value)
    return out
