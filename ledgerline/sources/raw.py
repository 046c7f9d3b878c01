"""Landing of monthly CSV drops: every column as text, with lineage."""

from __future__ import annotations

import csv
import io
import re
from collections.abc import Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime, timezone
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.contract import BATCH, FILENAME, LOADED, NOT_IN_NAMES
from ledgerline.operators.cleaning import null_sentinels
from ledgerline.operators.relational import union_aligned

BATCH_FOLDER = r"batch_(\d+)"
# A CSV, plain or in a compression Spark reads anywhere.
CSV_NAME = r"(.*)\.csv(\.gz|\.bz2|\.deflate)?"
# The line as it stands in the file, where it does not fit the header; why it was refused; 1 if so.
LINE, REASON, REFUSED = "_line", "_reject_reason", "_refused"


def _safe(stem: str) -> str:
    return re.sub(NOT_IN_NAMES, "_", stem.lower())


def _stem(filename: str) -> str:
    match = re.fullmatch(CSV_NAME, filename)
    return match.group(1) if match else filename.rsplit(".", 1)[0]


@dataclass(frozen=True)
class RawFile:
    """One CSV of a drop: a file, or a folder of that name with the parts of a large one."""

    batch_id: int
    name: str
    paths: tuple[str, ...]

    @property
    def family(self) -> str:
        """Which RAW dataset the file belongs to."""
        return _safe(_stem(self.name))

    @property
    def table(self) -> str:
        return raw_table_name(f"batch_{self.batch_id}", self.name)


def raw_table_name(batch: str, filename: str) -> str:
    """``batch_2`` and ``Late Usage.csv`` give ``batch_2_late_usage``."""
    return f"{batch}_{_safe(_stem(filename))}"


def discover(spark: SparkSession, root: str, batches: Sequence[int] | None = None) -> list[RawFile]:
    """CSV files of the batch folders under ``root``, by batch and name.

    A folder that is missing or holds no CSV contributes nothing. A folder named like a CSV
    holds its parts; one that is no CSV, and no marker (``_SUCCESS``, hidden files), raises: its
    rows would be missing without a word, and so does a CSV in a compression that is not read
    everywhere. Works on any file system Spark can read; only names
    are listed.
    """
    jvm = spark.sparkContext._jvm
    top = jvm.org.apache.hadoop.fs.Path(root)
    fs = top.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(top):
        return []
    found = []
    for folder in fs.listStatus(top):
        match = re.fullmatch(BATCH_FOLDER, folder.getPath().getName())
        if not folder.isDirectory() or not match:
            continue
        batch_id = int(match.group(1))
        if batches is not None and batch_id not in batches:
            continue
        for entry in fs.listStatus(folder.getPath()):
            name = entry.getPath().getName()
            if not re.fullmatch(CSV_NAME, name):
                if re.fullmatch(r"[^_.].*\.csv\.[^.]+", name, re.IGNORECASE):
                    raise ValueError(f"a CSV in a compression that is not understood: {entry.getPath().toString()}")
                continue
            parts = [p.getPath() for p in (fs.listStatus(entry.getPath()) if entry.isDirectory() else [entry])]
            parts = [p for p in parts if not p.getName().startswith(("_", "."))]
            strange = [p.toString() for p in parts if not re.fullmatch(CSV_NAME, p.getName())]
            if strange:
                raise ValueError(f"parts that are no CSV: {strange[:5]}")
            found.append(RawFile(batch_id, name, tuple(sorted(p.toString() for p in parts))))
    return sorted(found, key=lambda f: (f.batch_id, f.name))


def _reader(spark: SparkSession, multi_line: bool):
    # RFC 4180 quoting: a quote inside a quoted value is doubled.
    # Every field is parsed whatever a query asks for: only so a line can be seen not to fit.
    return spark.read.option("header", True).option("escape", '"').option("multiLine", multi_line).option("columnPruning", False)


def _headers(spark: SparkSession, paths: Sequence[str]) -> dict[str, tuple[str, ...]]:
    """First record of every file, split into column names; an empty file has none.

    Only the header is read (over several lines where a quoted name spans them), by a few
    threads of the driver, without a Spark job per file.
    """
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()

    def first_line(path: str) -> tuple[str, ...]:
        location = jvm.org.apache.hadoop.fs.Path(path)
        stream = location.getFileSystem(conf).open(location)
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(location)
        try:
            reader = jvm.java.io.BufferedReader(
                jvm.java.io.InputStreamReader(codec.createInputStream(stream) if codec else stream, "UTF-8")
            )
            header = reader.readLine()
            while header and header.count('"') % 2 and (more := reader.readLine()) is not None:
                header += "\n" + more
        finally:
            stream.close()
        return tuple(next(csv.reader(io.StringIO(header.lstrip("\ufeff"), newline="")))) if header else ()

    with ThreadPoolExecutor(max_workers=16) as pool:
        return dict(zip(paths, pool.map(first_line, paths)))


def paths_with_line_breaks(spark: SparkSession, paths: Sequence[str]) -> set[str]:
    """Paths of the files in which a quoted value spans lines.

    Such a file has lines with an odd number of quotes. It has to be parsed as a whole;
    all others can be split over tasks.
    """
    lines = spark.read.text(list(paths)).select("value", F.col("_metadata.file_path").alias("path"))
    odd = F.length("value") - F.length(F.replace(F.col("value"), F.lit('"'), F.lit("")))
    # Few lines hold a quote at all. One row per file at most; the driver needs the names to choose the reader.
    return {r["path"] for r in lines.filter(F.contains("value", F.lit('"')) & (odd % 2 == 1)).select("path").distinct().collect()}


def read_lines(
    spark: SparkSession, files: Iterable[RawFile], loaded_at: datetime | None = None, multi_line: bool | set[str] | None = None
) -> DataFrame:
    """All lines of one file family from one scan: rows (``_refused`` 0) and rejects (1).

    A line with more fields than its header is refused and kept as it stands, with the reason;
    a shorter line is a row whose last columns are NULL. Sentinels become NULL.
    """
    rows = _read(spark, files, loaded_at, multi_line)
    rows = rows.withColumn(REFUSED, _refused(rows).cast("int")).drop("_fields")
    unfit = F.col(REFUSED) == 1
    return null_sentinels(rows).withColumns({LINE: F.when(unfit, F.col(LINE)), REASON: F.when(unfit, F.lit("more fields than the header"))})


def accepted(lines: DataFrame) -> DataFrame:
    """The rows among the lines."""
    return lines.filter(F.col(REFUSED) == 0).drop(LINE, REASON, REFUSED)


def refused(lines: DataFrame) -> DataFrame:
    """The rejects among the lines, with lineage and the reason. Rows and rejects add up to the lines."""
    return lines.filter(F.col(REFUSED) == 1).select(LINE, REASON, BATCH, LOADED, FILENAME)


def read_raw(
    spark: SparkSession, files: Iterable[RawFile], loaded_at: datetime | None = None, multi_line: bool | set[str] | None = None
) -> DataFrame:
    """The rows of one file family, without those :func:`read_rejects` returns."""
    return accepted(read_lines(spark, files, loaded_at, multi_line))


def read_rejects(
    spark: SparkSession, files: Iterable[RawFile], loaded_at: datetime | None = None, multi_line: bool | set[str] | None = None
) -> DataFrame:
    """Lines with more fields than their header, as they stand, with lineage and the reason."""
    return refused(read_lines(spark, files, loaded_at, multi_line))


def _refused(rows: DataFrame):
    """More fields than the header: separators outside quoted values are counted in lines that do not fit."""
    bare = F.regexp_replace(LINE, '"[^"]*"', "")  # a doubled quote ends one match and begins the next
    fields = F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit(""))) + 1
    return F.coalesce(fields > F.col("_fields"), F.lit(False))


def _read(
    spark: SparkSession, files: Iterable[RawFile], loaded_at: datetime | None, multi_line: bool | set[str] | None
) -> DataFrame:
    """All lines of one file family with batch, load time and file name, and what does not fit.

    Files are grouped by their header, one scan per distinct header, and the scans are
    united by column name: a batch with other columns can never shift values, and the
    plan does not grow with the number of batches. ``multi_line=None`` finds out which
    files need whole-file parsing; a set is what :func:`paths_with_line_breaks` found before.
    """
    of_path = {p: f for f in files for p in f.paths}
    paths = list(of_path)
    stamp = (loaded_at or datetime.now(timezone.utc)).replace(tzinfo=None).isoformat(sep=" ")
    if multi_line is None:
        multi_line = paths_with_line_breaks(spark, paths) if paths else set()
    broken = {_plain_path(p) for p in multi_line} if isinstance(multi_line, set) else None

    groups: dict[tuple[tuple[str, ...], bool], list[str]] = {}
    for path, header in _headers(spark, paths).items():
        spanning = multi_line if broken is None else _plain_path(path) in broken
        if header:
            groups.setdefault((header, spanning), []).append(path)

    in_drop = f"^.*/{BATCH_FOLDER}/([^/]+)"
    scans = []
    for (header, spanning), members in groups.items():
        schema = T.StructType([T.StructField(c, T.StringType()) for c in (*header, LINE)])
        rows = _reader(spark, spanning).schema(schema).option("columnNameOfCorruptRecord", LINE).csv(members)
        # A reader may not be asked for unfit lines alone, so the count of fields looks at a column too.
        fields = F.lit(len(header)) + F.least(F.length(F.coalesce(F.col(f"`{header[0]}`"), F.lit(""))), F.lit(0))
        origins = {(of_path[p].batch_id, of_path[p].name) for p in members}
        if len(origins) == 1:
            (batch, name), = origins  # parts of one CSV: nothing to find out row by row
            origin = [F.lit(batch).alias(BATCH), F.lit(name).alias(FILENAME)]
        else:
            path = F.col("_metadata.file_path")
            # The path comes URI-encoded, where a plus is a plus.
            decoded = F.url_decode(F.replace(F.regexp_extract(path, in_drop, 2), F.lit("+"), F.lit("%2B")))
            origin = [F.regexp_extract(path, in_drop, 1).cast("int").alias(BATCH), decoded.alias(FILENAME)]
        scans.append(rows.select(*[F.col(f"`{c}`") for c in header], LINE, fields.alias("_fields"), *origin))
    if not scans:
        empty = f"{LINE} string, _fields int, {BATCH} int, {LOADED} timestamp_ntz, {FILENAME} string"
        return spark.createDataFrame([], empty)
    rows = union_aligned(scans).withColumn(LOADED, F.lit(stamp).cast("timestamp_ntz"))
    lineage = [BATCH, LOADED, FILENAME]
    return rows.select(*[F.col(f"`{c}`") for c in rows.columns if c not in lineage], *lineage)


def _plain_path(path: str) -> str:
    """File metadata spells paths as URIs: blanks as %20, other slashes after the scheme."""
    return re.sub(r"^([a-z0-9]+):/+", r"\1:/", unquote(path))


def families(files: Iterable[RawFile]) -> dict[str, list[RawFile]]:
    """Files by RAW family."""
    grouped: dict[str, list[RawFile]] = {}
    for f in files:
        grouped.setdefault(f.family, []).append(f)
    return grouped


def rows_per_file(files: Sequence[RawFile]) -> dict[str, Column]:
    """An aggregate per file of one family that counts its rows while they are written."""
    return {
        f"n{i}": F.count_if((F.col(REFUSED) == 0) & (F.col(FILENAME) == f.name) & (F.col(BATCH) == f.batch_id)) for i, f in enumerate(files)
    }


def load_summary(spark: SparkSession, counts: Sequence[tuple[RawFile, int]]) -> DataFrame:
    """Rows per loaded file; a file with only a header counts 0."""
    return spark.createDataFrame([(f.table, f.batch_id, n) for f, n in counts], f"table string, {BATCH} int, rows long")
