"""Readers: raw files, decoded images, delimited text, and a metadata-only inventory."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fovea.functions.paths import class_from_path, path_segments, plain_path
from fovea.session import stage

# Schema of Spark's binaryFile source; a stream over it has to name it.
BINARY_SCHEMA = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("modificationTime", T.TimestampType()),
        T.StructField("length", T.LongType()),
        T.StructField("content", T.BinaryType()),
    ]
)

GLOB_CHARACTERS = set("*?[]{}")


def read_binary(
    spark: SparkSession,
    path: str | list[str],
    pattern: str | None = None,
    recursive: bool = False,
) -> DataFrame:
    """One row per file with its raw bytes; `path` is any Hadoop URI, glob, or list of them."""
    reader = spark.read.format("binaryFile")
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    return reader.load(path)


def read_class_tree(spark: SparkSession, root: str, pattern: str | None = None) -> DataFrame:
    """Raw file rows of the glob `<root>/*/*`: files in the class folders, and in folders directly in them.

    `root` may be any path or pattern. Only the class folders are resolved first; the glob itself would
    turn every file into a listing path of its own.
    """
    folders = class_folders(spark, root)
    files = read_binary(spark, [literal_path(f) for f in folders], pattern, recursive=True)
    return _two_levels(files.select("path", "modificationTime", "length", "content"), folders)


def _two_levels(files: DataFrame, folders: list[str]) -> DataFrame:
    """Files of the folders and of those directly in them; all folders match one pattern, so they lie
    equally deep."""
    return files.where(F.size(path_segments("path")) <= folders[0].count("/") + 3)


def class_folders(spark: SparkSession, root: str) -> list[str]:
    """The folders that `<root>/*` matches, one for each class."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/*")
    system = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    found = system.globStatus(path) or []
    folders = sorted(status.getPath().toString() for status in found if status.isDirectory())
    if not folders:
        raise FileNotFoundError(f"no class folder matches {path}")
    return folders


def pack_files(spark: SparkSession, root: str, out: str, pattern: str | None = None) -> None:
    """`<root>/<class>/**` as one table of few large files, (path, length, content, class).

    Classes are read and appended one by one, so the driver never lists more than one of them. Read
    the table with `read_packed`; everything that takes file rows takes its rows. A later call
    appends, so a class that failed is packed again into a new table.
    """
    for folder in class_folders(spark, root):
        rows = read_binary(spark, literal_path(folder), pattern, recursive=True)
        rows = rows.select("path", "length", "content", F.lit(folder.rsplit("/", 1)[-1]).alias("class"))
        rows.write.mode("append").parquet(out)


def literal_path(path: str) -> str:
    """`path` with the characters of patterns escaped."""
    return "".join("\\" + c if c in GLOB_CHARACTERS else c for c in path)


def read_packed(spark: SparkSession, path: str) -> DataFrame:
    schema = "path string, length bigint, content binary, class string"
    return spark.read.schema(schema).parquet(path)


def read_images(
    spark: SparkSession,
    path: str | list[str],
    drop_invalid: bool = False,
    recursive: bool = False,
) -> DataFrame:
    """Images decoded by the JVM reader: struct `image` with bytes in BGR order.

    A file that is no image yields a row of height -1, or none with `drop_invalid`.
    """
    reader = spark.read.format("image").option("dropInvalid", str(drop_invalid).lower())
    return reader.option("recursiveFileLookup", str(recursive).lower()).load(path)


def read_image_tree(spark: SparkSession, root: str, drop_invalid: bool = False) -> DataFrame:
    """(path, image) of the files of `read_class_tree`, paths spelled as there."""
    folders = class_folders(spark, root)
    images = read_images(spark, [literal_path(f) for f in folders], drop_invalid, recursive=True)
    images = images.select(plain_path("image.origin").alias("path"), "image")
    return _two_levels(images, folders)


def read_delimited(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    sep: str = ",",
    header: bool = True,
) -> DataFrame:
    """Delimited text; without a schema every column is a string named by the header.

    Values that do not fit the schema become NULL; `read_delimited_checked` tells such lines apart.
    """
    reader = spark.read.option("header", str(header).lower()).option("sep", sep)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(path)


def read_delimited_checked(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    sep: str = ",",
    header: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects) of delimited text: every line is in one of them.

    Rejects are (path, line, reject_reason): lines of too few or too many fields, or with a value that is
    not of its column's type. The text is parsed once, with all columns, into a staged table: a reader
    that skips columns nobody asks for would not see what is wrong with them.
    """
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    corrupt = "_corrupt"
    while corrupt in schema.names:
        corrupt += "_"
    reader = spark.read.option("header", str(header).lower()).option("sep", sep)
    reader = reader.option("columnNameOfCorruptRecord", corrupt).option("mode", "PERMISSIVE")
    scan = reader.schema(T.StructType([*schema.fields, T.StructField(corrupt, T.StringType())])).csv(path)
    source = F.col("_metadata.file_path").alias("_path")
    staged = stage(scan.select(*map(_quoted, scan.columns), source), "delimited")
    line = F.col(corrupt)
    rows = staged.where(line.isNull()).select(*map(_quoted, schema.names))
    rejects = staged.where(line.isNotNull())
    # a separator inside of quotes parts no fields
    bare = F.regexp_replace(line, r'"(?:[^"\\]|\\.|"")*"', "")
    fields = F.regexp_count(bare, F.lit("\\Q" + sep + "\\E")) + 1
    reason = F.when(fields < len(schema), "too few fields").when(fields > len(schema), "too many fields")
    # of the columns, those that are NULL although their text is not empty
    wrong = [F.when(F.col(_quoted(f.name)).isNull(), F.lit(f.name)) for f in schema.fields
             if not isinstance(f.dataType, T.StringType)]
    wrong = F.concat_ws(", ", *wrong) if wrong else F.lit("")
    reason = reason.otherwise(F.concat(F.lit("not of its type: "), wrong))
    return rows, rejects.select(F.col("_path").alias("path"), line.alias("line"), reason.alias("reject_reason"))


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def list_files(spark: SparkSession, path: str, recursive: bool = False) -> DataFrame:
    """Files of a folder with size and time, e.g. to look at what was written. Reads no contents."""
    return read_binary(spark, path, recursive=recursive).select(
        "path", "length", "modificationTime"
    )


def dataset_inventory(
    files: DataFrame, path_col: str = "path", size_col: str = "length"
) -> DataFrame:
    """Files and bytes per class. On a binaryFile scan only listing metadata is read."""
    return (
        files.select(class_from_path(path_col).alias("class"), F.col(size_col).alias("size"))
        .groupBy("class")
        .agg(F.count("*").alias("n_files"), F.sum("size").alias("total_bytes"))
    )


def plan_small_files(spark: SparkSession, files_per_task: int) -> None:
    """Let one scan task take up to about `files_per_task` small files.

    Spark charges every file an opening cost when it packs files into tasks; the 4 MB default
    means at most 32 files a task, far too many tasks for billions of images.
    """
    limit = _byte_count(spark.conf.get("spark.sql.files.maxPartitionBytes"))
    spark.conf.set("spark.sql.files.openCostInBytes", str(max(limit // files_per_task, 1)))


def _byte_count(setting: str) -> int:
    number = setting.lower().removesuffix("b")
    powers = {"k": 1, "m": 2, "g": 3}
    if number[-1] in powers:
        return int(number[:-1]) * 1024 ** powers[number[-1]]
    return int(number)
