"""Sources: folders of files, ZIP archives, dictionaries, rules, other databases."""

from __future__ import annotations

import io
import json
import os
import re
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lavra.functions.text import key_from_path
from lavra.runtime import map_batches


def files(spark: SparkSession, folder: str, pattern: str = "*.pdf", largest: int = 500 << 20) -> DataFrame:
    """``process, path, modified, length, content`` of a folder's files up to ``largest`` bytes."""
    rows = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(folder)
    return rows.where(F.col("length") <= largest).select(key_from_path("path").alias("process"), "path", F.col("modificationTime").alias("modified"), "length", "content")


def files_or_cache(spark: SparkSession, folder: str, schema: str | None = None) -> DataFrame:
    """A folder's PDF files, or if there are none the analyses cached as JSON."""
    pdfs = files(spark, folder)
    if not pdfs.isEmpty():
        return pdfs
    reader = spark.read.option("multiLine", "true").option("pathGlobFilter", "*.json")
    return (reader.schema(schema) if schema else reader).json(folder).withColumn("process", key_from_path(F.col("_metadata.file_path")))


def archive_entries(archives: DataFrame, suffix: str = ".pdf") -> DataFrame:
    """``process, path, entry_no, entry, title, content``: an archive's files of one kind by name, each with its title.

    A file that is no archive gives no rows. Of archives with one process key the first path counts.
    """

    def run(batches):
        for processes, paths, contents in batches:
            out: list[list] = [[] for _ in range(6)]
            for process, path, content in zip(processes, paths, contents):
                try:
                    z = zipfile.ZipFile(io.BytesIO(content))
                except (zipfile.BadZipFile, TypeError):
                    continue
                names = sorted(n for n in z.namelist() if n.lower().endswith(suffix))
                for i, n in enumerate(names, 1):
                    for c, v in zip(out, (process, path, i, n, Path(n).stem, z.read(n))):
                        c.append(v)
            yield out

    first = archives.groupBy("process").agg(F.min("path").alias("path"))
    one = archives.join(first, ["process", "path"], "left_semi").select("process", "path", "content")
    return map_batches(one, run, "process string, path string, entry_no int, entry string, title string, content binary")


def entry_ranges(entries: DataFrame, pages: str = "pages") -> DataFrame:
    """Where each entry's pages come to stand when an archive's files are put together: ``start_page, end_page``."""
    from pyspark.sql import Window

    w = Window.partitionBy("process").orderBy("entry_no")
    before = F.coalesce(F.sum(pages).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return entries.withColumn("start_page", before + 1).withColumn("end_page", before + F.col(pages))


def merge_list(entries: DataFrame) -> DataFrame:
    """``process, value``: the numbered titles of each process, a line each."""
    rows = F.sort_array(F.collect_list(F.struct("entry_no", "title")))
    return entries.groupBy("process").agg(F.array_join(F.transform(rows, lambda r: F.concat(r["entry_no"].cast("string"), F.lit(". "), r["title"])), "\n").alias("value"))


def dictionary(spark: SparkSession, path: str, columns: dict[str, str] | None = None, sep: str = ",") -> DataFrame:
    """A CSV dictionary keyed by its header, case ignored; short rows are padded; ``columns`` renames."""
    df = spark.read.option("header", "true").option("sep", sep).option("quote", '"').option("escape", '"').option("multiLine", "true").option("mode", "PERMISSIVE").csv(path)
    df = df.toDF(*(c.strip().lower().lstrip("﻿") for c in df.columns))
    return df.select(*(F.col(a.lower()).alias(b) for a, b in columns.items())) if columns else df


def aliases(spark: SparkSession, path: str) -> DataFrame:
    """``target_id, keyword`` of a JSON list of ``target_id, keywords``."""
    df = spark.read.schema("target_id string, keywords array<string>").option("multiLine", "true").json(path)
    return df.select("target_id", F.explode("keywords").alias("keyword"))


def rule_files(folder: str) -> list[dict]:
    """The parsed YAML files of a folder, by name; malformed ones are skipped. JSON files are read too."""
    out = []
    for p in sorted(Path(folder).iterdir()):
        try:
            if p.suffix in (".yml", ".yaml"):
                import yaml

                out.append(yaml.safe_load(p.read_text(encoding="utf-8")))
            elif p.suffix == ".json":
                out.append(json.loads(p.read_text(encoding="utf-8")))
        except Exception:  # noqa: BLE001  a file that can't be parsed
            continue
    return [d for d in out if isinstance(d, dict)]


def settings(json_file: str | None = None, env_file: str | None = None, prefix: str = "LAVRA_") -> dict[str, str]:
    """Layered settings: a JSON file, then a .env file, then the environment; camelCase and snake_case keys are one."""
    out: dict[str, str] = {}
    snake = lambda k: re.sub(r"(?<=[a-z0-9])([A-Z])", r"_\1", k).lower()
    if json_file and os.path.exists(json_file):
        out |= {snake(k): str(v) for k, v in json.loads(Path(json_file).read_text(encoding="utf-8")).items()}
    if env_file and os.path.exists(env_file):
        for line in Path(env_file).read_text(encoding="utf-8").splitlines():
            k, eq, v = line.partition("=")
            if eq and not k.strip().startswith("#"):
                out[snake(k.strip().removeprefix(prefix))] = v.strip().strip("\"'")
    return out | {snake(k.removeprefix(prefix)): v for k, v in os.environ.items() if k.startswith(prefix)}


def database(spark: SparkSession, url: str, query: str, **options: str) -> DataFrame:
    """A query of another database through JDBC; filters and columns are pushed to it."""
    return spark.read.format("jdbc").option("url", url).option("query", query).options(**options).load()


def raw_page(rows: DataFrame, name_like: str, order: str, limit: int, offset: int) -> DataFrame:
    """A page of raw processes: those whose key contains a text, case ignored, newest first."""
    return rows.where(F.lower("process").contains(name_like.lower())).orderBy(F.desc(order), "process").offset(offset).limit(limit)


def page_kind(chars: str | Column, images: str | Column) -> Column:
    """Empty, Text, ScannedImage or Mixed from the characters of the trimmed text and the images.

    Up to 50 characters are a scan, with an image or without; only pages with neither are empty.
    """
    c = F.col(chars) if isinstance(chars, str) else chars
    i = F.col(images) if isinstance(images, str) else images
    return F.when((c == 0) & (i == 0), "Empty").when(c <= 50, "ScannedImage").when(i > 0, "Mixed").otherwise("Text")


def text_coverage(chars: str | Column) -> Column:
    c = F.col(chars) if isinstance(chars, str) else chars
    return F.least(F.lit(100.0), c / 2000 * 100)


def rebuilt(pages: DataFrame, documents: DataFrame, **children: DataFrame) -> DataFrame:
    """Pages with their document's columns and, for each child table, its rows of the page as an array of structs."""
    out = pages.join(documents, ["process", "document_id"])
    for name, child in children.items():
        columns = [c for c in child.columns if c not in ("process", "page")]
        grouped = child.groupBy("process", "page").agg(F.sort_array(F.collect_list(F.struct(*columns))).alias(name))
        out = out.join(grouped, ["process", "page"], "left")
    return out


def by_place(rows: DataFrame, place: int, order: str = "created_at") -> DataFrame:
    """The row at a place, from 1, of all rows from the newest."""
    return rows.orderBy(F.desc(order), "process").offset(place - 1).limit(1)


def by_process(rows: DataFrame, process: str) -> DataFrame:
    return rows.where(F.col("process") == process)


def manifest(files: DataFrame, entries: DataFrame) -> DataFrame:
    """``process, pdf, from_zip, titles``: of each process its first file and, if it came from an archive, the titles in it."""
    first = files.groupBy("process").agg(F.min("path").alias("pdf"))
    titles = entries.groupBy("process").agg(F.transform(F.sort_array(F.collect_list(F.struct("entry_no", "title"))), lambda x: x["title"]).alias("titles"))
    out = first.join(titles, "process", "full")
    return out.select("process", F.coalesce("pdf", F.lit("")).alias("pdf"), F.col("titles").isNotNull().alias("from_zip"), F.coalesce("titles", F.array().cast("array<string>")).alias("titles"))


PAGE_SCHEMA = "path string, page int, width double, height double, text string"


def pages_source(read_pages=None, name: str = "pages"):
    """A data source (register it with ``spark.dataSource.register``) that gives a row for each page of the files in a folder.

    ``read_pages(path)`` yields ``(page, width, height, text)``; without it form feeds part the pages of text files. A reader of
    another format is given by whoever has its library; files are read on the workers, one partition a file.
    """
    from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

    class File(InputPartition):
        def __init__(self, path: str):
            self.path = path

    def plain(path: str):
        text = Path(path).read_text(encoding="utf-8", errors="replace")
        for i, page in enumerate(text.split("\f"), 1):
            yield i, None, None, page

    reader = read_pages or plain

    class Reader(DataSourceReader):
        def __init__(self, options):
            self.folder, self.pattern = options["path"], options.get("pattern", "*")

        def partitions(self):
            return [File(str(p)) for p in sorted(Path(self.folder.removeprefix("file:")).rglob(self.pattern)) if p.is_file()]

        def read(self, partition):
            for page, width, height, text in reader(partition.path):
                yield partition.path, page, width, height, text

    class Pages(DataSource):
        @classmethod
        def name(cls):
            return name

        def schema(self):
            return PAGE_SCHEMA

        def reader(self, schema):
            return Reader(self.options)

    return Pages


def checked_path(path: str, allowed: list[str]) -> str:
    """The path if it lies in one of the allowed folders, else an error."""
    full = os.path.realpath(path)
    if not any(full == os.path.realpath(a) or full.startswith(os.path.realpath(a).rstrip("/") + "/") for a in allowed):
        raise PermissionError(f"{path} lies in none of the allowed folders")
    return path
