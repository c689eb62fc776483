"""Delimited files of unknown separator and header naming."""

from __future__ import annotations

import csv
import re
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..operators.dedup import drop_missing

# Fixed values: (substrings of the header, target); the first rule that hits
# names the column.
ALIASES = (
    (("product",), "product_category"),
    (("sub",), "subcategory"),
    (("category", "cat"), "category"),
)
COLUMNS = ("category", "subcategory", "product_category")
SEPARATORS = ("\t", ",")
MIN_COLUMNS = 3
# Bytes of a file that are read at a time until its first line ends, and files looked at side by side.
_HEAD_BYTES = 1 << 16
_HEAD_THREADS = 32


def target_of(header: str, aliases=ALIASES) -> str | None:
    name = header.casefold()
    return next((t for parts, t in aliases if any(p in name for p in parts)), None)


def split_header(line: str, separators: Sequence[str] = SEPARATORS) -> tuple[str, list[str]]:
    """The first separator that yields enough columns, and the header cells."""
    for sep in separators:
        cells = next(csv.reader([line], delimiter=sep), [])
        if len(cells) >= MIN_COLUMNS:
            return sep, [c.strip() for c in cells]
    raise ValueError(f"no separator splits the header into {MIN_COLUMNS} columns: {line!r}")


def alias_columns(df: DataFrame, aliases=ALIASES, columns: Sequence[str] = COLUMNS):
    """Select the hierarchy columns by what their headers contain."""
    found: dict[str, str] = {}
    for c in df.columns:
        target = target_of(c, aliases)
        if target in found:
            raise ValueError(f"headers {found[target]!r} and {c!r} both mean {target}")
        if target:
            found[target] = c
    missing = [c for c in columns if c not in found]
    if missing:
        raise ValueError(f"no header means {missing}; headers are {df.columns}")
    return df.select(*[F.col(f"`{found[c]}`").alias(c) for c in columns])


def headers(spark: SparkSession, path: str) -> list[tuple[str, str]]:
    """(file, first line) of every file under ``path``; empty files have none.

    Spark lists the files, and the first block of each is read through Spark's file
    systems, so what is read does not grow with the size of the files.
    """
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    codecs = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf)

    def first(uri: str) -> tuple[str, str]:
        file = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(uri))
        stream = file.getFileSystem(conf).open(file)
        try:
            codec = codecs.getCodec(file)
            source = codec.createInputStream(stream) if codec else stream
            head = b""
            while block := source.readNBytes(_HEAD_BYTES):
                head += block
                if b"\n" in block or b"\r" in block:
                    break
        finally:
            stream.close()
        lines = re.split(rb"\r\n|\r|\n", head, maxsplit=1)
        return file.toString(), lines[0].decode("utf-8", "replace") if head else ""

    with ThreadPoolExecutor(_HEAD_THREADS) as pool:
        found = list(pool.map(first, spark.read.text(path).inputFiles()))
    return sorted((file, line) for file, line in found if line)


def read_delimited(
    spark: SparkSession,
    path: str,
    na_tokens: Sequence[str] = (),
    strict_single: bool = False,
    multiline: bool = False,
    keep_all: bool = False,
) -> DataFrame:
    """Read TAB- or comma-separated files, all columns as strings.

    Every file is read by its own header and separator, and columns meet by
    name. Rows lacking a hierarchy value or with a blank item are dropped,
    unless ``keep_all`` asks for every column and row as read. A row with more
    cells than its header is an error when it is read; :func:`malformed_rows`
    lists such rows. ``na_tokens`` are texts to read as NULL. ``strict_single``
    demands exactly one CSV file. ``multiline`` allows line breaks inside
    quotes, at the price that a file is no longer split between tasks.
    """
    if strict_single:
        files = [f for f in spark.read.text(path).inputFiles() if f.lower().endswith(".csv")]
        if len(files) != 1:
            raise ValueError(f"expected one CSV file under {path}, found {len(files)}")
    parts = []
    for raw in _raw_parts(spark, path, multiline):
        told = F.concat(F.lit("more cells than the header has: "), F.col(_MALFORMED))
        first = raw.columns[0]
        checked = F.when(_too_wide(raw), F.raise_error(told)).otherwise(F.col(f"`{first}`"))
        part = raw.withColumn(first, checked.cast("string")).drop(_MALFORMED)
        if na_tokens:
            part = part.select(
                *[F.when(~F.col(f"`{c}`").isin(*na_tokens), F.col(f"`{c}`")).alias(c) for c in part.columns]
            )
        parts.append(part if keep_all else drop_missing(alias_columns(part), COLUMNS, ["product_category"]))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def malformed_rows(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """``(line)``: the rows that have more cells than the header of their file."""
    parts = [
        raw.where(_too_wide(raw)).select(F.col(_MALFORMED).alias("line"))
        for raw in _raw_parts(spark, path, multiline)
    ]
    return reduce(DataFrame.union, parts)


_MALFORMED = "_malformed"


def _too_wide(raw: DataFrame):
    # Rows that are too short lack their last cells; those are NULL and no error.
    return F.col(_MALFORMED).isNotNull() & F.col(f"`{raw.columns[-2]}`").isNotNull()


def _raw_parts(spark: SparkSession, path: str, multiline: bool) -> list[DataFrame]:
    """One table for each separator and header that occurs, with the malformed lines."""
    kinds: dict[tuple, list[str]] = {}
    for file, line in headers(spark, path):
        sep, cells = split_header(line.lstrip("\ufeff"))
        kinds.setdefault((sep, tuple(cells)), []).append(file)
    if not kinds:
        raise ValueError(f"nothing to read under {path}")
    return [
        spark.read.schema(StructType([StructField(c, StringType()) for c in (*cells, _MALFORMED)])).options(
            header=True, sep=sep, quote='"', escape='"', multiLine=multiline, enforceSchema=True,
            columnNameOfCorruptRecord=_MALFORMED, columnPruning=False,
        ).csv(files)
        for (sep, cells), files in kinds.items()
    ]


def write_delimited(df: DataFrame, path: str, sep: str = ",") -> None:
    """CSV with header. Always a new path: never the one being read."""
    df.write.options(header=True, sep=sep, quote='"', escape='"').csv(path)
