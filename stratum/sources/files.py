"""File sources: bulk loads that match columns by name, and file landing.

`load_by_name` is a bulk load that matches columns by name, ignoring case:
columns are matched to the target schema by name ignoring case, missing
columns load as NULL and extra columns are ignored; a glob on the file name
selects which files load. Parquet does the matching in the scan itself (the
requested schema is resolved case-insensitively and pruned to the target's
columns); CSV files are grouped by their header line, read as text under it, then cast to the target types;
JSON lines are parsed into a text map with lower-cased keys (Spark's JSON
reader matches names case-sensitively), then each target field is cast.
JSON fields must be flat (a nested value arrives as its JSON text).
"""

from __future__ import annotations

import fnmatch
import re
import uuid
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratum.operators.staging import conform


def by_header(spark: SparkSession, path: str | Sequence[str], pattern: str | None, encoding: str = "UTF-8") -> dict[str, list[str]]:
    """Files of a CSV load by their first line. One open and one line per file, several files at once; files
    without any line have nothing to load and are left out. Compressed files are read by their ending."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    jpath = jvm.org.apache.hadoop.fs.Path
    glob = fnmatch.translate(pattern) if pattern else None
    found: list[str] = []

    def walk(fs, status) -> None:
        name = status.getPath().getName()
        if name.startswith(("_", ".")):
            return
        if status.isDirectory():
            for inner in fs.listStatus(status.getPath()):
                walk(fs, inner)
        elif glob is None or re.match(glob, name):
            found.append(status.getPath().toString())

    for root in [path] if isinstance(path, str) else path:
        fs = jpath(root).getFileSystem(conf)
        for status in fs.globStatus(jpath(root)) or []:
            for inner in fs.listStatus(status.getPath()) if status.isDirectory() else [status]:
                walk(fs, inner)
    codecs = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf)

    def first_line(file: str) -> str | None:
        p = jpath(file)
        stream = p.getFileSystem(conf).open(p)
        try:
            codec = codecs.getCodec(p)
            text = codec.createInputStream(stream) if codec is not None else stream
            return jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(text, encoding)).readLine()
        finally:
            stream.close()

    groups: dict[str, list[str]] = {}
    with ThreadPoolExecutor(16) as pool:
        for file, line in zip(found, pool.map(first_line, found)):
            if line is not None:
                groups.setdefault(line, []).append(file)
    return groups


def load_by_name(spark: SparkSession, path: str | Sequence[str], schema: T.StructType, *, fmt: str = "parquet",
                 pattern: str | None = None, regex: str | None = None,
                 options: dict | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """Load files under `path` into `schema`, columns matched by name ignoring case.

    `pattern` is a glob on file names, applied while listing; `regex` a full
    regular expression on the file path (e.g. `.*employee_data_part_.*[.]parquet`),
    applied to the file-metadata column of each row. CSV files may differ in the
    order and choice of their columns: each is read under its own header.
    `keep`: file-metadata fields (such as `file_path`) to return after the columns.
    """
    if regex:
        df = load_by_name(spark, path, schema, fmt=fmt, pattern=pattern, options=options, keep=[*dict.fromkeys([*keep, "file_path"])])
        df = df.filter(F.col("file_path").rlike(f"^(?:{regex})$"))
        return df.select(*schema.names, *keep)
    reader = spark.read.format(fmt)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    if fmt == "csv":
        # Values are read by place under a header: files with one header share a reader, aligned by name.
        parts = []
        for _, group in sorted(by_header(spark, path, pattern, (options or {}).get("encoding", "UTF-8")).items()):
            plain = spark.read.format("csv").options(**(options or {})).option("header", "true")
            first = plain.option("inferSchema", "false").load(group)
            parts.append(conform(plain.schema(first.schema).option("enforceSchema", "false").load(group), schema, keep=keep))
        return reduce(DataFrame.unionByName, parts) if parts else conform(spark.createDataFrame([], schema), schema)
    if fmt == "json":
        return json_by_name(reader.format("text").load(path), schema, keep)
    return conform(reader.schema(schema).load(path), schema, keep=keep)


def json_by_name(lines: DataFrame, schema: T.StructType, keep: Sequence[str] = ()) -> DataFrame:
    """JSON lines (a text source, batch or stream) as columns matched by name ignoring case."""
    fields = F.map_entries(F.from_json(F.col("value"), T.MapType(T.StringType(), T.StringType())))

    def named(name: str):  # of keys that differ in case only, the first counts
        return F.get(F.filter(fields, lambda e: F.lower(e["key"]) == name.lower()), F.lit(0))["value"]
    return lines.select(*[named(f.name).cast(f.dataType).alias(f.name) for f in schema.fields], *[F.col(f"_metadata.{k}") for k in keep])


def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def land_files(spark: SparkSession, df: DataFrame, slice_col: str, dest: str, prefix: str,
               fmt: str = "parquet", scratch: str | None = None, options: dict | None = None) -> list[str]:
    """Upload rows to a landing folder as files named `{prefix}_{slice:02d}_{n}.{fmt}`.

    Spark writes the slices in parallel (one folder per slice value) into a
    scratch folder beside `dest`; each finished file is then renamed into
    `dest`, so a file appears there whole (what a file stream needs).
    Returns the landed file names.
    """
    scratch = scratch or f"{dest.rstrip('/')}_upload_{uuid.uuid4().hex[:8]}"
    writer = df.write.mode("overwrite").partitionBy(slice_col).format(fmt)
    for k, v in (options or {}).items():
        writer = writer.option(k, v)
    writer.save(scratch)
    fs, root = _fs(spark, scratch)
    _, dest_path = _fs(spark, dest)
    fs.mkdirs(dest_path)
    landed = []
    for part_dir in fs.listStatus(root):
        name = part_dir.getPath().getName()
        if not name.startswith(f"{slice_col}="):
            continue
        sl = int(name.split("=", 1)[1])
        files = sorted((f.getPath() for f in fs.listStatus(part_dir.getPath())
                        if f.getPath().getName().startswith("part-")), key=lambda p: p.getName())
        n = 0
        for f in files:
            while fs.exists(spark._jvm.org.apache.hadoop.fs.Path(dest_path, f"{prefix}_{sl:02d}_{n}.{fmt}")):
                n += 1
            target = f"{prefix}_{sl:02d}_{n}.{fmt}"
            if not fs.rename(f, spark._jvm.org.apache.hadoop.fs.Path(dest_path, target)):
                raise OSError(f"could not land {f} as {target}")
            landed.append(target)
    return landed
