"""Raw layer: every column a string, missing-value tokens normalised, one lineage key per record."""

from __future__ import annotations

import csv
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallystone.functions.parsing import null_if_na
from tallystone.schema import EXPECTED_COLUMNS, raw_columns

UNIT_SEPARATOR = "\x1f"
# Raw columns never hold this token: the scan turns it into null.
NULL_MARK = "<NA>"
COPIES_PER_CHUNK = 65_536
# Columns of a header that are looked at when expected ones are sought.
MOST_COLUMNS = 200
# Hexadecimal digits: 96 bits of a document's digest, all of a record's.
TAG_LENGTH, DIGEST_LENGTH = 24, 32


def normalise_na(df: DataFrame) -> DataFrame:
    """Turn every missing-value token of the string columns into null."""
    strings = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    return df.select(*[null_if_na(F.col(c)).alias(c) if c in strings else F.col(c) for c in df.columns])


def as_raw(df: DataFrame) -> DataFrame:
    """Any table as a raw one: strings only (dates print as yyyy-MM-dd), tokens normalised."""
    return normalise_na(df.select(*[F.col(c).cast("string").alias(c) for c in df.columns]))


def read_raw_csv(spark: SparkSession, path: str, dataset: str) -> DataFrame:
    """Scan one raw CSV table as strings. The header decides which columns exist, so a file that lacks
    an expected column still loads and the schema check reports it.

    Quotes inside quoted fields are doubled, and quoted fields may hold line breaks. The columns are those of the first file's
    header; a further file whose header differs in names or order is an error, not a shift of values."""
    raw_columns(dataset)
    reader = spark.read.options(header=True, quote='"', escape='"', multiLine=True)
    columns = reader.csv(path).columns  # the header only
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    scan = reader.schema(schema).option("enforceSchema", False).csv(path)
    return with_row_uid(normalise_na(scan), dataset)


SOURCE_FILE, ROW_INDEX, CORRUPT = "source_file", "row_index", "corrupt_record"
LINEAGE = (SOURCE_FILE, ROW_INDEX, CORRUPT)


def csv_headers(spark: SparkSession, path: str) -> DataFrame:
    """The header line of each file under a path: source_file, header. A file without any line has none.

    The first block of a file is read by one task in order, so its first line is the one met first."""
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias(SOURCE_FILE), F.col("_metadata.file_block_start").alias("start"), "value"
    )
    return lines.where("start = 0").groupBy(SOURCE_FILE).agg(F.first("value").alias("header"))


def scan_csv(spark: SparkSession, path: str, dataset: str, places: bool = True) -> DataFrame:
    """Scan the CSV files of a raw table whose headers may differ: files are grouped by header, read together, and united by column
    name. A column that a file lacks is null in its records; `absent_columns` reports it.

    Beside the data there are, for lineage, the file and the record's number in it, counted from 0: a key of the physical record
    that stays the same on every reading, made without a shuffle of the records. And, in `corrupt_record`, the text of a
    record with more or fewer fields than its header; its leading fields are kept, missing ones are null. Without `places` the
    records are not numbered, which saves a second look at the files."""
    raw_columns(dataset)
    groups = csv_headers(spark, path).groupBy("header").agg(F.collect_list(SOURCE_FILE).alias("files")).collect()
    parts = [_scan_files(spark, sorted(g["files"]), next(csv.reader([g["header"]]), []), places) for g in sorted(groups, key=lambda g: g["header"])]
    if not parts:
        parts = [spark.createDataFrame([], ", ".join([*[f"`{c}` string" for c in EXPECTED_COLUMNS[dataset]], "source_file string, row_index long, corrupt_record string"]))]
    whole = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    known = [c for c in raw_columns(dataset) if c in whole.columns]
    others = sorted(c for c in whole.columns if c not in known and c not in LINEAGE)
    return _keyed(whole, [*known, *others], dataset)


def _keyed(whole: DataFrame, columns: list[str], dataset: str) -> DataFrame:
    """Data columns normalised and keyed by content; the lineage columns do not count as content."""
    clean = whole.select(*[null_if_na(F.col(c)).alias(c) for c in columns], *[c for c in LINEAGE if c in whole.columns])
    return with_row_uid(clean, dataset, columns)


def _scan_files(spark: SparkSession, files: list[str], names: list[str], places: bool) -> DataFrame:
    if len(set(names)) != len(names):
        raise ValueError(f"a column occurs twice in the header {names} of {files[0]}")
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*names, CORRUPT]])
    options = dict(header=True, quote='"', escape='"', multiLine=True, mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT)
    scan = spark.read.schema(schema).options(**options).csv(files)
    if not places:
        return scan.select("*", F.col("_metadata.file_path").alias(SOURCE_FILE))
    # A file with quoted line breaks is read by one task, in order; so its records have rising numbers without gaps.
    numbered = scan.select("*", F.col("_metadata.file_path").alias(SOURCE_FILE), F.monotonically_increasing_id().alias("place"))
    heads = numbered.groupBy(SOURCE_FILE).agg(F.min("place").alias("head"))  # one row per file
    return numbered.join(heads, SOURCE_FILE).withColumn(ROW_INDEX, F.col("place") - F.col("head")).drop("place", "head")


def physical_rows(scan: DataFrame) -> DataFrame:
    """A Parquet scan with the file and the record's number in it, from the hidden columns of the scan."""
    return scan.select("*", F.col("_metadata.file_path").alias(SOURCE_FILE), F.col("_metadata.row_index").alias(ROW_INDEX))


def physical_id() -> Column:
    """The key of a physical record, of a scan with lineage."""
    return F.concat_ws("#", F.col(SOURCE_FILE), F.col(ROW_INDEX).cast("string"))


def absent_columns(headers: DataFrame, dataset: str) -> DataFrame:
    """Expected columns that the header of a file lacks: source_file, field."""
    columns = F.from_csv("header", ", ".join(f"c{i} string" for i in range(MOST_COLUMNS)), {"quote": '"', "escape": '"'})
    present = F.array_compact(F.array(*[columns[f"c{i}"] for i in range(MOST_COLUMNS)]))
    expected = F.array(*[F.lit(c) for c in EXPECTED_COLUMNS[dataset]])
    return headers.select(SOURCE_FILE, F.explode(F.array_except(expected, present)).alias("field"))


def read_raw_parquet(spark: SparkSession, path: str, dataset: str) -> DataFrame:
    """Scan one raw table kept as Parquet."""
    raw_columns(dataset)
    return with_row_uid(as_raw(spark.read.parquet(path)), dataset)


def read_all_raw(spark: SparkSession, root: str, suffix: str = ".csv") -> dict[str, DataFrame]:
    reader = read_raw_csv if suffix == ".csv" else read_raw_parquet
    return {name: reader(spark, f"{root}/{name}{suffix}", name) for name in EXPECTED_COLUMNS}


def content_hash(columns: list[str]) -> Column:
    """128-bit digest of a record. Null and empty text differ; column order matters."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit(NULL_MARK)) for c in columns]
    return F.md5(F.concat_ws(UNIT_SEPARATOR, *parts))


def with_row_uid(df: DataFrame, dataset: str, content: list[str] | None = None) -> DataFrame:
    """Add the lineage key `row_uid`: the dataset name and the record's digest.

    It needs no shuffle and no file order, and survives a re-read. Byte-identical copies share a key; every
    rule gives them the same verdict, so splits and joins on the key stay right. `number_copies` makes the
    key unique per physical record where that is wanted. In a table with documents the digest follows the document's tag, so
    an issue names the document of its record without a look at the table. content: the columns that make up the record, by default
    all."""
    columns = [c for c in df.columns if c != "row_uid"]
    digest = content_hash(content or columns)
    parts = [F.lit(dataset.upper() + "_"), digest]
    if "document_id" in columns:
        parts.insert(1, _tag(F.coalesce(F.col("document_id"), digest)))
    return df.select(F.concat(*parts).alias("row_uid"), *columns)


def _tag(document: Column) -> Column:
    return F.substring(F.md5(document), 1, TAG_LENGTH)


def tag_of_leg() -> Column:
    """The tag of a leg's document, made of the document's id. Only a leg without document needs its lineage key for it, which costs far
    more."""
    return F.coalesce(_tag(F.col("document_id")), document_tag(F.col("row_uid")))


def document_tag(uid: Column) -> Column:
    """The tag of a record's document, from its lineage key. Records without document have one of their own, which only
    their copies share."""
    return F.substring(uid, -(TAG_LENGTH + DIGEST_LENGTH), TAG_LENGTH)


def number_copies(df: DataFrame) -> DataFrame:
    """Make `row_uid` unique by an ordinal among identical copies.

    Copies collapse to a count before the shuffle and are handed out again in chunks, so a record that
    makes up a large part of the table is spread over many tasks."""
    columns = [c for c in df.columns if c != "row_uid"]
    counted = df.groupBy("row_uid").agg(
        F.count(F.lit(1)).alias("n_copies"), *[F.first(c).alias(c) for c in columns]
    )
    last_chunk = F.floor((F.col("n_copies") - 1) / COPIES_PER_CHUNK)
    chunked = counted.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("bigint"), last_chunk)))
    spread = chunked.repartition("row_uid", "chunk")
    start = F.col("chunk") * COPIES_PER_CHUNK + 1
    stop = F.least(F.col("n_copies"), (F.col("chunk") + 1) * COPIES_PER_CHUNK)
    numbered = spread.withColumn("copy_no", F.explode(F.sequence(start, stop)))
    uid = F.concat_ws("_", "row_uid", F.col("copy_no").cast("string"))
    return numbered.select(uid.alias("row_uid"), *columns)


def null_counts(df: DataFrame, dataset: str) -> DataFrame:
    """Rows and missing values per column of a raw table, in one pass."""
    columns = [c for c in df.columns if c not in ("row_uid", "document_tag", *LINEAGE)]
    totals = df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.count_if(F.col(c).isNull()).alias(c) for c in columns],
    )
    return totals.unpivot("n_rows", columns, "column_name", "n_missing").select(
        F.lit(dataset).alias("dataset"), "column_name", "n_rows", "n_missing"
    )


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)
