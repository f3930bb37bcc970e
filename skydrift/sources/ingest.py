"""Ingest of raw flight CSV files (OP-01..06, 12).

The files are selected by a name pattern and read as text, one scan for each
distinct header (no inference pass), pruned by name to the 33 raw columns, and
cast in one typed projection. Input splits replace the original fixed-size
chunks.
"""

from __future__ import annotations

import csv
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skydrift.functions.exprs import (
    text_nullable, text_to_bool, text_to_date, text_to_double, text_to_int_rounded)
from skydrift.schemas import RAW_FLIGHT_COLUMNS

# Raw file name pattern (four-digit year).
RAW_FILE_GLOB = "Combined_Flights_[0-9][0-9][0-9][0-9].csv"


#: Header lines that the driver reads at a time.
HEADER_THREADS = 16
#: A header line has no more bytes than this.
HEADER_BYTES = 1 << 20


def _first_line(spark: SparkSession, path: str) -> str:
    """A file's first line, from its first bytes only; no job."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = place.getFileSystem(spark._jsc.hadoopConfiguration()).open(place)
    try:
        held = b""
        while b"\n" not in held and len(held) < HEADER_BYTES:
            more = bytes(stream.readNBytes(4096))
            held += more
            if len(more) < 4096:
                break
    finally:
        stream.close()
    return held.split(b"\n", 1)[0].removeprefix(b"\xef\xbb\xbf").decode("utf-8", "replace").rstrip("\r")


def _headers(spark: SparkSession, path: str, file_glob: str) -> dict[tuple[str, ...], list[str]]:
    """The matching files by their header. One job lists the files and reads no
    content; the driver reads each file's first bytes, some files at a time."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", file_glob)
             .option("recursiveFileLookup", True).load(path).select("path"))
    paths = [r.path for r in files.sort("path").collect()]  # one row per file
    groups: dict[tuple[str, ...], list[str]] = {}
    with ThreadPoolExecutor(HEADER_THREADS) as pool:
        for name, line in zip(paths, pool.map(lambda p: _first_line(spark, p), paths)):
            groups.setdefault(tuple(next(csv.reader([line]), [])), []).append(name)
    return groups


def read_raw_text(spark: SparkSession, path: str, file_glob: str = RAW_FILE_GLOB,
                  columns: Sequence[str] | None = None,
                  skipped: list[str] | None = None) -> DataFrame:
    """OP-01/02: CSV scan by file-name pattern; every column is text, the
    empty string is NULL; the listed columns are selected by name, whatever
    else a file's header holds and in whatever order.

    A file without one of the columns raises, unless ``skipped`` is given:
    then it is left out and named there. Malformed lines are kept with NULLs
    (PERMISSIVE); an unreadable file fails the read."""
    cols = list(columns) if columns is not None else [c for c, _ in RAW_FLIGHT_COLUMNS]
    text = T.StructType([T.StructField(c, T.StringType(), True) for c in cols])
    out = spark.createDataFrame([], text)
    for header, files in _headers(spark, path, file_glob).items():
        absent = [c for c in cols if c not in header]
        if absent:
            if skipped is None:
                raise ValueError(f"{files}: no column {', '.join(absent)}")
            skipped.extend(files)
            continue
        schema = T.StructType([T.StructField(c, T.StringType(), True) for c in header])
        part = (spark.read.schema(schema).option("header", True)
                .option("mode", "PERMISSIVE").option("nullValue", "").csv(files))
        out = out.unionByName(part.select(*cols))
    return out


def cast_raw(text: DataFrame, types: Sequence[tuple[str, str]] = RAW_FLIGHT_COLUMNS) -> DataFrame:
    """OP-03: one typed projection. ints go text -> NUMERIC -> INT with
    rounding; floats text -> double; dates text -> date; booleans only from
    the exact words True / False."""
    conv = {"int": text_to_int_rounded, "double": text_to_double, "date": text_to_date,
            "boolean": text_to_bool, "string": text_nullable}
    return text.select(*[conv[t](c).alias(c) for c, t in types if c in text.columns])


def sql_source(spark: SparkSession, query: str) -> DataFrame:
    """OP-06: an arbitrary SQL string over registered views."""
    return spark.sql(query)


def pruned_columns(sig_a: Sequence[str], sig_b: Sequence[str], extra: Sequence[str]) -> list[str]:
    """OP-12: union of both models' features plus the key and truths, sorted."""
    return sorted(set(sig_a) | set(sig_b) | set(extra))


def write_text_csv(df: DataFrame, path: str) -> None:
    """Serialise a frame as header CSV text (empty string for NULL; booleans
    as the words True / False, as in the raw extracts)."""
    types = {f.name: f.dataType for f in df.schema.fields}

    def text(c):
        if isinstance(types[c], T.BooleanType):
            return F.when(F.col(c), "True").when(~F.col(c), "False").alias(c)
        return F.col(c).cast("string").alias(c)
    df.select(*[text(c) for c in df.columns]) \
        .write.mode("overwrite").option("header", True).option("nullValue", "") \
        .option("emptyValue", "").csv(path)


def publish_csv(df: DataFrame, path: str, name: str) -> None:
    """Text CSV files of ``df``, each named ``name`` in a folder of its own
    below ``path`` (the raw extracts carry the year in their names)."""
    write_text_csv(df, f"{path}/written")
    spark = df.sparkSession
    hadoop = spark._jvm.org.apache.hadoop.fs
    written = hadoop.Path(f"{path}/written")
    fs = written.getFileSystem(spark._jsc.hadoopConfiguration())
    for n, status in enumerate(fs.globStatus(hadoop.Path(written, "part-*.csv"))):
        folder = hadoop.Path(f"{path}/{n}")
        fs.mkdirs(folder)
        fs.rename(status.getPath(), hadoop.Path(folder, name))
