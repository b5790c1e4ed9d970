"""Readers: scans, text folders, tolerant and strict JSON lines, reports, catalogs, archives."""

from __future__ import annotations

import json
import re
import tarfile
from collections.abc import Iterator
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

IMAGES = ("png", "jpg", "jpeg", "tif", "tiff", "bmp", "webp", "pdf")
REPORT = (
    "file_name STRING, status STRING, n_blocks INT, n_blocks_kept INT, deskew_angle DOUBLE, out_txt STRING, error STRING, "
    "t_load_s DOUBLE, t_deskew_s DOUBLE, t_segment_s DOUBLE, t_ocr_s DOUBLE, t_write_s DOUBLE, t_total_s DOUBLE"
)


def file_names(spark: SparkSession, folder: str, recursive: bool = True, suffixes: tuple[str, ...] = IMAGES) -> DataFrame:
    """path and length of a folder's files with one of the suffixes, in any case; no file is opened."""
    scan = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower()).load(folder)
    return scan.filter(F.lower(F.regexp_extract("path", r"\.([^./]+)$", 1)).isin(*suffixes)).select("path", "length")


def pages(spark: SparkSession, folder: str, recursive: bool = True, suffixes: tuple[str, ...] = IMAGES, limit: int | None = None) -> DataFrame:
    """path, length and content of images and PDFs, by suffix in any case.

    In no order: sorting would move every scan's bytes; sort by path what is made of them.
    limit: only the first so many by path, chosen by their names before any is read.
    """
    if limit is not None:
        named = [r["path"] for r in file_names(spark, folder, recursive, suffixes).select("path").orderBy("path").limit(limit).collect()]
        scan = spark.read.format("binaryFile").load(named) if named else file_names(spark, folder, recursive, suffixes).limit(0).withColumn("content", F.lit(None).cast("binary"))
        return scan.select("path", "length", "content")
    scan = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower()).load(folder)
    return scan.filter(F.lower(F.regexp_extract("path", r"\.([^./]+)$", 1)).isin(*suffixes)).select("path", "length", "content")


def sample_pages(spark: SparkSession, folder: str, count: int, seed: int) -> DataFrame:
    """path, length and content of ``count`` files drawn at random; the same seed draws the same files."""
    names = file_names(spark, folder)
    drawn = [r["path"] for r in names.orderBy(F.xxhash64(F.lit(seed), "path"), "path").limit(count).collect()]
    return spark.read.format("binaryFile").load(drawn).select("path", "length", "content") if drawn else pages(spark, folder, limit=0)


def ids_from_names(spark: SparkSession, folder: str, suffix: str, pattern: str = r"^(CH-\d+-[A-Z0-9]+)_full$") -> DataFrame:
    """norm_id of the files whose name without its suffix fits the pattern's first group, once each."""
    name = F.regexp_replace(F.substring_index("path", "/", -1), r"\.[^.]*$", "")
    found = F.regexp_extract(name, pattern, 1)
    return file_names(spark, folder, False, (suffix,)).select(found.alias("norm_id")).filter("norm_id <> ''").distinct()


def manifest_ids(spark: SparkSession, path: str, column: str = "norm_id") -> DataFrame:
    """The stripped identifiers of a manifest CSV, in no order, repeated ones as often as they stand there."""
    return spark.read.csv(path, header=True).select(F.trim(column).alias(column))


def json_object(path: str) -> dict:
    """The object in a JSON file on the driver, empty if there is no file."""
    file = Path(path)
    return json.loads(file.read_text(encoding="utf-8")) if file.exists() else {}


def texts(spark: SparkSession, folder: str, bad_bytes: str = "drop") -> DataFrame:
    """file_name, path and ocr_text of a folder's .txt files, one row a file.

    bad_bytes: drop leaves bytes that are no UTF-8 out, replace keeps U+FFFD for them.
    """
    if bad_bytes not in ("drop", "replace"):
        raise ValueError(f"unknown bad_bytes {bad_bytes!r}")
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").load(folder)
    text = F.try_validate_utf8(F.col("content").cast("string"))
    fixed = F.make_valid_utf8(F.col("content").cast("string"))
    if bad_bytes == "drop":
        fixed = F.replace(fixed, F.lit("�"), F.lit(""))
    full = files.select(F.substring_index("path", "/", -1).alias("file_name"), "path", F.coalesce(text, fixed).alias("ocr_text"))
    empty = [(p.rsplit("/", 1)[-1], p, "") for p in _empty_files(spark, folder, "*.txt")]
    return full.unionByName(spark.createDataFrame(empty, full.schema)) if empty else full


def _empty_files(spark: SparkSession, folder: str, glob: str) -> list[str]:
    """Files without a byte, which Spark's scans leave out."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder.rstrip("/") + "/" + glob)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    return [str(f.getPath()) for f in found or [] if f.isFile() and f.getLen() == 0]


def json_lines(spark: SparkSession, path: str, schema: str, mode: str = "skip") -> DataFrame:
    """Rows of a JSON lines file. mode: skip leaves malformed lines and those that are no object out, strict fails on them."""
    if mode == "strict":
        return spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    if mode != "skip":
        raise ValueError(f"unknown mode {mode!r}")
    lines = spark.read.text(path).filter(F.trim("value") != "")
    kept = lines.filter(F.coalesce(F.schema_of_variant(F.try_parse_json("value")).startswith("OBJECT"), F.lit(False)))
    return kept.select(F.from_json("value", schema).alias("r")).select("r.*")


def report(spark: SparkSession, path: str) -> DataFrame:
    """An OCR report; floats are read from their printed form."""
    return spark.read.csv(path, schema=REPORT, header=True)


def catalog_ids(spark: SparkSession, paths: list[str], column: str = "norm_id", pattern: str = r"^CH-\d+-") -> DataFrame:
    """Identifiers of several catalog files that fit a pattern, once each, by their number; source is the first file that has it."""
    ranks = F.create_map(*[F.lit(x) for i, p in enumerate(paths) for x in (p.rsplit("/", 1)[-1], i)])
    read = spark.read.csv(paths, header=True).select(F.trim(column).alias(column), ranks[F.substring_index(F.input_file_name(), "/", -1)].alias("source"))
    ids = read.filter(F.col(column).rlike(pattern)).groupBy(column).agg(F.min("source").alias("source"))
    return ids.orderBy(F.regexp_extract(column, r"-(\d+)-", 1).try_cast("int"), column)


class _Archive(InputPartition):
    def __init__(self, path: str):
        self.path = path


class _ArchiveReader(DataSourceReader):
    def __init__(self, options):
        self.paths = [p for p in options.get("paths", options.get("path", "")).split(",") if p]
        self.wanted = {w for w in options.get("wanted", "").split(",") if w}

    def partitions(self) -> list[InputPartition]:
        return [_Archive(p) for p in self.paths]

    def read(self, partition: _Archive) -> Iterator[tuple]:
        left = set(self.wanted)
        with tarfile.open(partition.path, "r|*") as archive:
            for member in archive:
                name = member.name.rsplit("/", 1)[-1]
                if not member.isfile() or self.wanted and name not in left:
                    continue
                yield partition.path, name, member.size, archive.extractfile(member).read()
                left.discard(name)
                if self.wanted and not left:
                    return  # everything wanted was found; the rest isn't unpacked


class ArchiveSource(DataSource):
    """Members of tar archives, one task an archive, read in one pass.

    Options: paths, comma separated; wanted, file names to look for (all if left out).
    """

    @classmethod
    def name(cls) -> str:
        return "archive_members"

    def schema(self) -> str:
        return "archive string, name string, size bigint, content binary"

    def reader(self, schema) -> DataSourceReader:
        return _ArchiveReader(self.options)


def archive_members(spark: SparkSession, paths: list[str], wanted: list[str] | None = None) -> DataFrame:
    """archive, name, size and content of members of tar archives."""
    spark.dataSource.register(ArchiveSource)
    reader = spark.read.format("archive_members").option("paths", ",".join(paths))
    return (reader.option("wanted", ",".join(wanted)) if wanted else reader).load()


def run_texts_folder(texts_folder: str | None, run_folder: str | None) -> str:
    """The folder of texts, named itself or as the run it belongs to."""
    if texts_folder:
        return texts_folder
    if run_folder:
        return re.sub(r"/+$", "", run_folder) + "/texts"
    raise ValueError("name the folder of texts or the run")
