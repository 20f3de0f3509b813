"""Raw listing files: CSV scan, bounded probe, row key, dataset information."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from tasador.functions.numeric import nan_to_null
from tasador.functions.text import missing_to_null
from tasador.operators.lookup import small_enough
from tasador.sources.csv_records import BLOCK, BYTE_ORDER_MARK, BYTES, FILE, POSITION, first_records, headers, parsed, read_records

#: Columns that keep where a row was read.
PLACE = (FILE, BLOCK, BYTES, POSITION)

# The listing columns that hold numbers; ``id`` and the place columns are texts.
NUMBER_COLUMNS = (
    "price", "price_usd", "surface_total", "surface_covered", "rooms", "bedrooms", "bathrooms",
)
TEXT_COLUMNS = ("id", "l1", "l2", "l3", "state_name", "operation_type", "property_type")


def files_with_line_breaks(spark: SparkSession, path: str, pattern: str = "*.csv") -> set[str]:
    """Files with a line that holds an odd number of quotes, so that a quoted text goes on in the next one. One pass that splits large files."""
    lines = spark.read.option("pathGlobFilter", pattern).text(path).select("value", F.col("_metadata.file_path").alias("path"))
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    return {r.path for r in lines.where(quotes % 2 == 1).select("path").distinct().collect()}


def read_csv(spark: SparkSession, path: str, multiline: bool | None = None, pattern: str = "*.csv") -> DataFrame:
    """All matching files below ``path`` as texts, columns by header, with the file, its bytes and the block of each row.

    Files whose headers differ are read by their own header each; a column that a file lacks is missing in its rows. By default quoted texts may hold line breaks: the lines are read
    once, by many tasks for a large file, and kept in the shared folder until their records are put together. Without any line break in quotes ``multiline=False`` saves the stored lines;
    ``multiline=True`` leaves the parsing to one task for each file. The rows are the same.
    """
    if multiline is None:
        return read_records(spark, path, pattern)
    found = headers(spark, path, pattern).withColumn("header", F.ltrim(F.col("header"), F.lit(BYTE_ORDER_MARK)))
    distinct = sorted(r.header for r in found.select("header").distinct().collect())  # distinct headers only

    def reader():
        return spark.read.option("header", True).option("escape", '"').option("multiLine", multiline)

    if len(distinct) <= 1:
        parts = [reader().option("pathGlobFilter", pattern).csv(path)]
    else:
        files = {h: sorted(unquote(r.path) for r in found.where(F.col("header") == h).select("path").collect()) for h in distinct}  # paths only
        parts = [reader().csv(group) for group in files.values()]
    placed = [p.withColumns({FILE: F.col("_metadata.file_path"), BLOCK: F.col("_metadata.file_block_start"), BYTES: F.col("_metadata.file_size")}) for p in parts]
    whole = placed[0]
    for part in placed[1:]:
        whole = whole.unionByName(part, allowMissingColumns=True)
    return whole


def _typed(name: str, kind: str | None) -> Column:
    text = missing_to_null(F.col(f"`{name}`"))
    return (text.try_cast(kind) if kind else text).alias(name)


def infer_kinds(texts: DataFrame, names: list[str]) -> dict[str, str | None]:
    """One pass: a column whose present texts all read as numbers is ``bigint`` or ``double``."""
    if not names:
        return {}
    tests = []
    for n in names:
        text = missing_to_null(F.trim(F.col(f"`{n}`")))
        tests += [
            F.count(text),
            F.count(text.try_cast("double")),
            F.count_if(text.rlike(r"^[+-]?\d{1,18}$")),
        ]
    row = texts.agg(*[t.alias(f"t{i}") for i, t in enumerate(tests)]).first()
    kinds = {}
    for i, n in enumerate(names):
        present, numbers, whole = row[3 * i : 3 * i + 3]
        kinds[n] = "bigint" if whole == present > 0 else "double" if numbers == present else None
    return kinds


def load_listings(spark: SparkSession, path: str, multiline: bool | None = None, infer: bool = False) -> DataFrame:
    """Listings with typed columns, NaN as NULL, and ``property_id``.

    The known columns have declared types, so no pass over the data is needed; ``infer`` adds
    one pass that types the others, which otherwise stay texts.
    """
    return _listings(read_csv(spark, path, multiline), infer)


def _listings(texts: DataFrame, infer: bool = False) -> DataFrame:
    names = [n for n in texts.columns if n not in PLACE]
    kinds = {n: "double" if n in NUMBER_COLUMNS else None for n in names}
    if infer:
        kinds.update(infer_kinds(texts, [n for n in names if n not in NUMBER_COLUMNS + TEXT_COLUMNS]))
    place = [c for c in PLACE if c in texts.columns]
    return add_property_id(nan_to_null(texts.select(*[_typed(n, k) for n, k in kinds.items()], *place))).drop(*PLACE)


def probe(spark: SparkSession, path: str, rows: int = 1000, multiline: bool | None = None) -> DataFrame:
    """The first rows of the files, by path, as a load with the same option gives them, for a look at their columns.

    Only the beginnings of as many files as needed are read; the driver holds these rows.
    """
    parts, before = [], 0
    for header, records in first_records(spark, path, rows, breaks=multiline is not False):
        numbered = [(r, "", 0, 0, before + i) for i, r in enumerate(records)]
        parts.append(parsed(spark.createDataFrame(numbered, "value string, path string, block long, bytes long, position long"), header))
        before += len(records)
    if not parts:
        return load_listings(spark, path, multiline).limit(0)
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part, allowMissingColumns=True)
    return _listings(whole)


def add_property_id(df: DataFrame) -> DataFrame:
    """``property_id``: the text of ``id``, or without one the row position from 0."""
    if "id" in df.columns:
        return df.withColumn("property_id", F.coalesce(F.col("id").cast("string"), F.lit("nan")))
    if POSITION in df.columns:
        return df.withColumn("property_id", F.col(POSITION).cast("string"))
    placed = add_row_position(df, "property_id")
    return placed.withColumn("property_id", F.col("property_id").cast("string"))


def add_row_position(df: DataFrame, name: str) -> DataFrame:
    """Contiguous positions from 0 in the order of files (by path), blocks and rows, for a frame that reads files directly.

    Each row knows its file and block, and each task numbers the rows of a block in turn. The only exchange is the row count of each block.
    """
    if FILE in df.columns:
        tagged, added = df, []
    else:
        tagged, added = df.withColumns({FILE: F.col("_metadata.file_path"), BLOCK: F.col("_metadata.file_block_start")}), [FILE, BLOCK]
    tagged = tagged.withColumn("_tag", F.monotonically_increasing_id())
    sizes = tagged.groupBy(F.col(FILE).alias("_of"), F.col(BLOCK).alias("_at")).agg(F.count(F.lit(1)).alias("_rows"), F.min("_tag").alias("_first"))
    before = F.sum("_rows").over(Window.orderBy("_of", "_at").rowsBetween(Window.unboundedPreceding, -1))  # a row for each block
    starts = sizes.select("_of", "_at", "_first", F.coalesce(before, F.lit(0)).alias("_start"))
    side = F.broadcast(starts) if small_enough(starts) else starts
    joined = tagged.join(side, (F.col(FILE) == F.col("_of")) & (F.col(BLOCK) == F.col("_at")))
    return joined.withColumn(name, F.col("_start") + F.col("_tag") - F.col("_first")).drop("_tag", "_of", "_at", "_first", "_start", *added)


def dataset_info(files: DataFrame) -> DataFrame:
    """Rows, files and bytes of a frame that reads files directly; one pass, no column is read."""
    path, size = (FILE, BYTES) if BYTES in files.columns else ("_metadata.file_path", "_metadata.file_size")
    parts = files.select(F.col(path).alias("path"), F.col(size).alias("size"))
    per_file = parts.groupBy("path").agg(F.count(F.lit(1)).alias("rows"), F.max("size").alias("size"))
    return per_file.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("total_rows"),
        F.count(F.lit(1)).alias("n_files"),
        F.coalesce(F.sum("size"), F.lit(0)).alias("total_bytes"),
    )
