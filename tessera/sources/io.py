"""Readers and writers: per-period CSV folders, staffing files, model tables.

Folder listing goes through the Hadoop FileSystem of the session, so the
same code lists local, HDFS or object-store paths.  Files are grouped by
their header line and each group is read once with an explicit schema:
Spark maps columns of a multi-file CSV read by position, so mixing layouts
in one read would shift values silently.
"""

from __future__ import annotations

import csv
import io
import re
from collections import defaultdict
from concurrent.futures import ThreadPoolExecutor

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.expressions import parse_season_label, to_number, two_digit_year


# ------------------------------------------------------------------ listing
def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def glob_files(spark: SparkSession, pattern: str) -> list[str]:
    """Sorted file paths matching a Hadoop glob."""
    fs, p = _fs(spark, pattern)
    st = fs.globStatus(p)
    return sorted(s.getPath().toString() for s in (st or []) if s.isFile())


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def folder_label(path: str) -> str:
    """Name of the folder holding ``path``; a ``key=value`` folder gives ``value``."""
    name = path.rstrip("/").split("/")[-2]
    return name.split("=", 1)[1] if "=" in name else name


def folder_label_col(file_path: Column) -> Column:
    name = F.regexp_extract(file_path, r"/([^/]+)/[^/]*$", 1)
    return F.regexp_replace(name, r"^[^=]*=", "")


def first_lines(spark: SparkSession, files: list[str], report=print, threads: int = 16) -> dict[str, str]:
    """First line of each file that has one, read through the session's FileSystem.

    Only the first bytes of each file are read, by a few threads (no Spark
    job, no full scan).  A file that can't be opened or is empty is reported
    and left out.
    """
    jvm = spark.sparkContext._jvm

    def one(f: str) -> str | None:
        fs, p = _fs(spark, f)
        stream = fs.open(p)
        try:
            return jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8")).readLine()
        finally:
            stream.close()

    out: dict[str, str] = {}
    with ThreadPoolExecutor(threads) as pool:
        for f, got in [(f, pool.submit(one, f)) for f in files]:
            try:
                line = (got.result() or "").lstrip("\ufeff")
            except Py4JJavaError as e:
                report(f"Skipping {f}: {e.java_exception}")
                continue
            if line.strip():
                out[f] = line
            else:
                report(f"Skipping {f}: it has no header")
    return out


def _parse_header(line: str | None) -> list[str]:
    if not line:
        return []
    return next(csv.reader(io.StringIO(line)), [])


def _ord(file_path: Column) -> Column:
    """File order: path, split start, row position inside the split."""
    return F.struct(file_path.alias("file"), F.col("_metadata.file_block_start").alias("block"),
                    F.monotonically_increasing_id().alias("row"))


#: Spellings of a missing value in text files, fixed values.
MISSING = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA",
           "NULL", "NaN", "None", "n/a", "nan", "null"]


def known_text(c: Column) -> Column:
    """The text, or NULL where it spells a missing value."""
    return F.when(~F.trim(c).isin(MISSING), c)


def _by_header(spark: SparkSession, files: list[str], report) -> dict[tuple, list[str]]:
    groups: dict[tuple, list[str]] = defaultdict(list)
    for f, h in first_lines(spark, files, report).items():
        groups[tuple(_parse_header(h))].append(f)
    return groups


def _texts(spark: SparkSession, names: list[str], files: list[str], multi_line: bool) -> DataFrame:
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    return spark.read.schema(schema).options(header=True, enforceSchema=True, multiLine=multi_line, escape='"').csv(files)


def _typed(value: dict[str, Column], known: dict[str, T.DataType]) -> dict[str, Column]:
    """The texts as the types declared for them; NULL where they don't parse."""
    out = {}
    for c, v in value.items():
        kind = known.get(c)
        out[c] = to_number(v).cast(kind) if isinstance(kind, (T.DoubleType, T.FloatType)) else v.try_cast(kind) if kind else v
    return out


# ------------------------------------------------------------------ readers
def read_seasons(spark: SparkSession, data_root: str, filename: str = "players.csv",
                 schema: T.StructType | None = None, period_col: str = "season_start",
                 ord_col: str = "ord", report=print, two_digit: bool = True, multi_line: bool | str = False) -> DataFrame:
    """Stack one CSV per period folder into one typed DataFrame.

    ``<root>/<label>/<filename>``; the period is the label's first two digits
    (below 50 -> 20xx, else 19xx), with ``two_digit=False`` its full start year
    where the label has four digits.  Folders whose label does not parse, and
    files that can't be read or have no header, are reported and left out;
    none left raises ValueError.  Every column is read as text, by its name in
    the file's header; spellings of a missing value are NULL, and so is what
    doesn't parse as the type that ``schema`` declares.  Columns it doesn't
    declare stay text, columns missing from some files are NULL there.  An
    ``ord`` column keeps file order for tie-breaks.  ``multi_line`` reads
    quoted values with line breaks, a file a task; ``multi_line="split"`` reads
    them in splits (``quoted.read_quoted``), and the headers by a Spark job.
    """
    root = data_root.rstrip("/")
    files = glob_files(spark, f"{root}/*/{filename}")
    good = []
    for f in files:
        if re.match(r"\d\d", folder_label(f)):
            good.append(f)
        else:
            report(f"Skipping {f}: folder label {folder_label(f)!r} is not a season")
    known = {f.name: f.dataType for f in (schema.fields if schema else [])}
    year_of = lambda label: (two_digit_year(label) if two_digit
                             else F.coalesce(parse_season_label(label), two_digit_year(label)))
    if multi_line == "split":
        from tessera.sources.quoted import by_name, read_quoted
        if not good:
            raise ValueError(f"No season files found under {data_root}")
        rows, headers = read_quoted(spark, good, report)
        if not headers:
            raise ValueError(f"No season files found under {data_root}")
        value = _typed({c: known_text(by_name(headers, c)) for c in dict.fromkeys(c for h in headers for c in h)}, known)
        return rows.select(*[v.alias(c) for c, v in value.items()],
                           year_of(folder_label_col(F.col("file"))).cast("int").alias(period_col), F.col("ord").alias(ord_col))
    parts = []
    for cols, group in _by_header(spark, good, report).items():
        names = [f"c{i}" for i in range(len(cols))]
        df = _texts(spark, names, group, multi_line)
        fp = F.col("_metadata.file_path")
        label = folder_label_col(fp)
        first = {c: n for n, c in reversed(list(zip(names, cols)))}
        value = _typed({c: known_text(F.col(n)) for c, n in first.items()}, known)
        parts.append(df.select(*[v.alias(c) for c, v in value.items()], year_of(label).cast("int").alias(period_col),
                               _ord(fp).alias(ord_col)))
    if not parts:
        raise ValueError(f"No season files found under {data_root}")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def read_staffing(spark: SparkSession, data_root: str, filename: str = "coaches.csv",
                  ord_col: str = "ord", report=print, multi_line: bool | str = False) -> DataFrame:
    """Staffing rows ``Coach, Tm, G, Season, ord`` from ``<root>/<label>/<filename>``.

    Columns are taken by position (the header repeats names): person at 0,
    group at 1, games at the first column named ``G`` or else 2.  Names are
    trimmed; games that are not an integer ('82.0', '') count as 0.  Blank
    lines are skipped.  ``Season`` is the folder label.  Files that can't be
    read or have no header are reported and left out; none left raises.
    ``multi_line`` as for :func:`read_seasons`.
    """
    if multi_line == "split":
        from tessera.sources.quoted import read_quoted
        files = glob_files(spark, f"{data_root.rstrip('/')}/*/{filename}")
        rows, headers = read_quoted(spark, files, report) if files else (None, [])
        if not headers:
            raise ValueError(f"No staffing files found under {data_root}")
        games = F.coalesce(*[F.when(F.col("layout") == k, F.get(F.col("values"), F.lit(h.index("G") if "G" in h else 2)))
                             for k, h in enumerate(headers)])
        text = lambda i: F.trim(F.coalesce(F.get(F.col("values"), F.lit(i)), F.lit("")))
        return rows.select(text(0).alias("Coach"), text(1).alias("Tm"), F.coalesce(games.try_cast("int"), F.lit(0)).alias("G"),
                           folder_label_col(F.col("file")).alias("Season"), F.col("ord").alias(ord_col))
    groups = _by_header(spark, glob_files(spark, f"{data_root.rstrip('/')}/*/{filename}"), report)
    parts = []
    for cols, group in groups.items():
        g_index = cols.index("G") if "G" in cols else 2
        width = max(len(cols), g_index + 1, 2)
        df = _texts(spark, [f"c{i}" for i in range(width)], group, multi_line)
        fp = F.col("_metadata.file_path")
        parts.append(df.select(
            F.trim(F.coalesce(F.col("c0"), F.lit(""))).alias("Coach"),
            F.trim(F.coalesce(F.col("c1"), F.lit(""))).alias("Tm"),
            F.coalesce(F.col(f"c{g_index}").try_cast("int"), F.lit(0)).alias("G"),
            folder_label_col(fp).alias("Season"),
            _ord(fp).alias(ord_col)))
    if not parts:
        raise ValueError(f"No staffing files found under {data_root}")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def read_model_table(spark: SparkSession, path: str, schema: T.StructType | None = None,
                     fmt: str = "csv") -> DataFrame:
    """Typed read of a modelling table; missing path or empty table raise."""
    if not path_exists(spark, path):
        raise FileNotFoundError(f"no table at {path}")
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True)
        reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    elif schema is not None:
        reader = reader.schema(schema)
    df = reader.load(path)
    if df.isEmpty():
        raise ValueError(f"the table at {path} has no rows")
    return df


# ------------------------------------------------------------------ writer
def write_table(df: DataFrame, path: str | None, fmt: str = "csv", mode: str = "overwrite",
                partition_by: list[str] | None = None, single_file: bool = False) -> str | None:
    """Write ``df`` (no path: no write).  CSV gets a header; NULL is empty.

    Writes a directory of part files; ``single_file`` coalesces to one part
    (only for small exports -- it funnels the data through one task).
    """
    if not path:
        return None
    out = df.coalesce(1) if single_file else df
    w = out.write.mode(mode).format(fmt)
    if fmt == "csv":
        w = w.option("header", True)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)
    return path
