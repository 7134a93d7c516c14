"""Sinks: CSV, JSON, text and XML writers, upserts into a table of files."""

from __future__ import annotations

import warnings

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lavra.functions.text import without_controls
from lavra.operators.resolve import insert_absent, upsert

FORMATS = ("txt", "json", "csv", "xml", "md", "parquet", "count", "raw")


def clean(df: DataFrame) -> DataFrame:
    """Every text column without control characters."""
    return df.withColumns({c: without_controls(c) for c, t in df.dtypes if t == "string"})


def write(df: DataFrame, path: str, form: str = "json", by: list[str] | None = None) -> None:
    """Write ``df``; with ``by`` a folder for each key. An unknown format falls back to JSON, with a warning."""
    if form not in FORMATS:
        warnings.warn(f"format {form!r} is unknown, JSON is written", stacklevel=2)
    if form == "count":
        df = df.agg(F.count("*").alias("count"))
        form = "json"
    if form in ("txt", "raw", "md"):
        lead = F.lit("- ") if form == "md" else F.lit("")
        df = df.select(F.concat(lead, F.concat_ws(" ", *(F.col(c).cast("string") for c in df.columns))).alias("value"))
        df.write.mode("overwrite").text(path)
        return
    w = df.write.mode("overwrite")
    if by:
        w = w.partitionBy(*by)
    if form == "csv":
        w.option("header", "true").option("sep", ";").option("quote", '"').option("escape", '"').csv(path)
    elif form == "xml":
        w.option("rowTag", "row").xml(path)
    elif form == "parquet":
        w.parquet(path)
    else:
        w.json(path)


def payload(rows: DataFrame, keys: list[str], by: Column | None = None) -> DataFrame:
    """``keys, part, payload``: the rows of each key as JSON arrays, in order of their columns, nulls included.

    ``by`` splits a key into parts; without it a key is one part and one row, whatever its size.
    """
    columns = [c for c in rows.columns if c not in keys]
    parts = rows.withColumn("part", F.lit(0).cast("long") if by is None else by.cast("long"))
    return parts.groupBy(*keys, "part").agg(F.to_json(F.sort_array(F.collect_list(F.struct(*columns))), {"ignoreNullFields": "false"}).alias("payload"))


def _folders(spark: SparkSession, path: str) -> list[str]:
    """The complete versions of a table, oldest first; a version is complete when its writer has left its mark."""
    jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(conf)
    if not fs.exists(p):
        return []
    names = sorted(x.getPath().getName() for x in fs.listStatus(p) if x.isDirectory() and x.getPath().getName().startswith("version="))
    return [n for n in names if fs.exists(jvm.org.apache.hadoop.fs.Path(f"{path}/{n}/_SUCCESS"))]


def read_table(spark: SparkSession, path: str) -> DataFrame | None:
    """The current version of a merged table, None before the first."""
    versions = _folders(spark, path)
    return spark.read.parquet(f"{path}/{versions[-1]}") if versions else None


def merge_into(spark: SparkSession, path: str, new: DataFrame, key: str, keep_old: bool = False, batch: str | None = None) -> None:
    """Upsert (or with ``keep_old`` insert what is absent) into a table of versions.

    A version is a folder that is read only once its writer has marked it complete, so readers always see one whole table and
    a crash loses nothing; the one before the last is kept, older ones are deleted. A ``batch`` that the current version was
    made from isn't applied again. One writer at a time. Works on every file system Hadoop knows.
    """
    path = path.rstrip("/")
    versions = _folders(spark, path)
    if batch is not None and versions and versions[-1].endswith(f"-{batch}"):
        return
    number = int(versions[-1].removeprefix("version=").split("-")[0]) + 1 if versions else 1
    old = read_table(spark, path)
    out = new if old is None else insert_absent(old, new, key) if keep_old else upsert(old, new, key)
    out.write.mode("overwrite").parquet(f"{path}/version={number:012d}" + (f"-{batch}" if batch is not None else ""))
    jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for name in versions[:-1]:
        p = jvm.org.apache.hadoop.fs.Path(f"{path}/{name}")
        p.getFileSystem(conf).delete(p, True)


def replace_groups(df: DataFrame, path: str, key: str) -> None:
    """Write ``df`` partitioned by ``key``; only the partitions it holds are replaced."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(key).parquet(path)


#: Columns of the table of processes that is exported, in order: fixed values.
EXPORT = (
    "process", "processo_administrativo", "processo_judicial", "comarca", "vara", "promovente", "promovido", "perito", "perito_cpf", "especialidade", "especie_pericia",
    "valor_arbitrado_jz", "valor_arbitrado_de", "valor_arbitrado_cm", "valor_arbitrado_final", "data_arbitrado_final", "despacho_label", "certidao_label", "requerimento_label",
)


def export_rows(rows: DataFrame, columns=EXPORT) -> DataFrame:
    """``place, line``: the lines of a CSV file with fixed columns: ``;`` between values, quotes only where they are needed, doubled inside.

    Columns that ``rows`` lacks and nulls are empty. The first line is the header; it begins with the mark of UTF-8.
    """
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")) if c in rows.columns else F.lit("")
    quoted = lambda v: F.when(v.rlike('[;"\\r\\n]'), F.concat(F.lit('"'), F.replace(v, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(v)
    body = rows.select(text(columns[0]).alias("place"), F.concat_ws(";", *(quoted(text(c)) for c in columns)).alias("line"))
    head = rows.sparkSession.createDataFrame([("", "\ufeff" + ";".join(columns))], "place string, line string")
    return head.unionByName(body)


def export_csv(rows: DataFrame, path: str, columns=EXPORT) -> None:
    """Write :func:`export_rows` as one file in order of the process; a row a process, so the table is small beside the pages."""
    lines = export_rows(rows, columns)
    lines.repartitionByRange(1, "place").sortWithinPartitions("place").select("line").write.mode("overwrite").text(path)


def document_summary(docs: DataFrame, columns: list[str]) -> DataFrame:
    """The asked columns of documents as text, '' for nulls and for columns that aren't there."""
    return docs.select(*((F.coalesce(F.col(c).cast("string"), F.lit("")) if c in docs.columns else F.lit("")).alias(c) for c in columns))


def copies(files: DataFrame, most: int | None = None, flat: bool = False) -> DataFrame:
    """``path, target, title, content``: loose files with the place they are copied to, a folder for each process or all in one.

    ``most`` keeps the first files by path.
    """
    name = F.regexp_extract("path", r"([^/\\]+)$", 1)
    rows = files if most is None else files.orderBy("path").limit(most)
    return rows.select("path", (name if flat else F.concat_ws("/", "process", name)).alias("target"), F.regexp_replace(name, r"\.[^.]*$", "").alias("title"), "content")
