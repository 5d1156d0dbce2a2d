"""Dated snapshot CSV folders → DataFrames with declared schemas.

Layout: ``<base>/<yyyyMMdd>/<category>[_<yyyyMMdd>].csv``.  All files of all
dates are one scan; the snapshot date and category come from each row's file
path (``_metadata.file_path``).

Files differ in the order and number of their columns, and Spark's reader takes
one header for a whole scan.  So a task gets whole files, reads each one's header
and then its rows, once: no pass over the files beforehand, and no list of files or
headers in the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import parse_dir_date
from ..operators.conform import conform
from ..schemas import CSV_SCHEMAS, MANDATORY_COLUMNS
from ..session import ship_package

# Folder date and file-name shape of the snapshot layout.  A
# folder may also be written ``key=value`` (Spark's partitioned writer).
DATE_DIR = r"/(?:[^/=]+=)?(\d{8})/(?:[^/]+/)?[^/]*$"
CATEGORY_FILE = r"/([^/]+?)(?:_\d{8})?\.csv$"
CATEGORY_DIR = r"/(?:category|category_file|cgid)=([^/]+)/[^/]*$"

ROWS_OUT = 5_000        # rows a task holds as Python objects at a time


def _decoded(text: Column) -> Column:
    """Percent-encoding undone (a plus sign stays one)."""
    return F.try_url_decode(F.replace(text, F.lit("+"), F.lit("%2B")))


def file_category(path: Column) -> Column:
    """Category of a snapshot file: from a ``category=…`` folder, whose writer
    escaped the value once more, or else from the file's name."""
    folder = F.regexp_extract(path, CATEGORY_DIR, 1)
    return F.when(folder != "", _decoded(_decoded(folder))).otherwise(
        _decoded(F.regexp_extract(path, CATEGORY_FILE, 1)))


def _rows_of_files(columns: list[str], mandatory: list[str], error_rows: bool):
    """(file_path, content) -> the rows of each file: ``columns`` by name, as text, and ``file_error``."""

    def header_of(reader) -> list[str]:
        for row in reader:
            names = [(c or "").strip().casefold() for c in row]
            if any(names):
                return names
        return []

    def run(batches):
        import csv
        import io
        import sys

        import pyarrow as pa

        csv.field_size_limit(sys.maxsize)
        schema = pa.schema([("file_path", pa.string()), *((f"c{i}", pa.string()) for i in range(len(columns))),
                            ("file_error", pa.string())])

        def out(path, rows, error=None):
            cols = list(zip(*rows)) if columns else []
            return pa.RecordBatch.from_arrays(
                [pa.array([path] * len(rows), pa.string()), *(pa.array(c, pa.string()) for c in cols),
                 pa.array([error] * len(rows), pa.string())], schema=schema)

        for b in batches:
            for path, content in zip(b.column("file_path"), b.column("content")):
                path, text = path.as_py(), content.as_py().decode("utf-8-sig", "replace")
                # an empty field is missing, a quoted empty one is empty text
                reader = csv.reader(io.StringIO(text, newline=""), quoting=csv.QUOTE_NOTNULL)
                names = header_of(reader)
                if not names:
                    continue
                lacks = [m for m in mandatory if m.casefold() not in names]
                known = [c for c in columns if c.casefold() in names]
                if lacks or not known:
                    error = (f"header lacks {', '.join(lacks) or 'every declared column'}: "
                             f"{','.join(names)}")
                    if not error_rows:
                        raise ValueError(f"{path}: {error}")
                    yield out(path, [[None] * len(columns)], error)
                    continue
                # a repeated name counts where it stands first
                at = [names.index(c.casefold()) if c in known else None for c in columns]
                rows = []
                for row in reader:
                    if not row or (len(row) == 1 and not (row[0] or "").strip()):
                        continue
                    n = len(row)
                    rows.append([row[i] if i is not None and i < n else None for i in at])
                    if len(rows) == ROWS_OUT:
                        yield out(path, rows)
                        rows = []
                if rows:
                    yield out(path, rows)

    return run


def read_csv_snapshots(spark: SparkSession, paths: str | list[str],
                       schema: T.StructType | str, exclude: list[str] | None = None,
                       mandatory: list[str] | None = None, error_rows: bool = False) -> DataFrame:
    """Read snapshot CSVs with a declared schema (never inferred), columns by name.

    ``schema`` is a StructType or a source key (``r1``/``r2``/``r3``).  Files may differ in the
    order of their columns, lack some (NULL) or have others (left out).  Blank lines, also before
    the header, a byte order mark, blanks around header names and their case do not matter;
    quoted fields may contain line breaks.  Adds ``snapshot_date`` (DATE, from the folder name),
    ``category`` (from the folder or file name) and ``file_path``.  Only the empty field is NULL:
    ``NA`` or ``None`` stay text; a value that does not fit its declared type is NULL.  ``exclude``
    names files to leave out, by exact file name.

    A file whose header lacks one of the ``mandatory`` columns (by default the id and name of the
    source's shape), or has no declared column at all, is never read as rows of NULL: the job fails
    and names it, or with ``error_rows`` it is one row that says so in the column ``file_error``
    (NULL elsewhere).  An empty file has no rows.

    Each byte is read once.  A task holds one file at a time; these are daily files of one
    category (the limit is Spark's 2 GB for a file read whole).
    """
    sch = CSV_SCHEMAS[schema] if isinstance(schema, str) else schema
    if mandatory is None:
        mandatory = MANDATORY_COLUMNS[schema] if isinstance(schema, str) else []
    ship_package(spark)
    columns = [f.name for f in sch.fields]
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
             .option("pathGlobFilter", "*.csv").load(paths))
    if exclude:
        files = files.where(~F.col("_metadata.file_name").isin(exclude))
    read = files.select(F.col("_metadata.file_path").alias("file_path"), "content").mapInArrow(
        _rows_of_files(columns, mandatory, error_rows),
        T.StructType([T.StructField("file_path", T.StringType()),
                      *(T.StructField(f"c{i}", T.StringType()) for i in range(len(columns))),
                      T.StructField("file_error", T.StringType())]))
    fp = F.col("file_path")
    named = read.select(
        *[F.col(f"c{i}").alias(c) for i, c in enumerate(columns)],
        parse_dir_date(F.regexp_extract(fp, DATE_DIR, 1)).alias("snapshot_date"),
        file_category(fp).alias("category"), _decoded(fp).alias("file_path"), "file_error")
    extra = [T.StructField("snapshot_date", T.DateType()), T.StructField("category", T.StringType()),
             T.StructField("file_path", T.StringType())]
    if error_rows:
        extra.append(T.StructField("file_error", T.StringType()))
    return conform(named, T.StructType(sch.fields + extra))


def read_name_column(spark: SparkSession, path: str, schema: T.StructType | str,
                     column: str = "product_name") -> DataFrame:
    """Scan of one column, found by its name in the header; no other is built."""
    sch = CSV_SCHEMAS[schema] if isinstance(schema, str) else schema
    only = T.StructType([f for f in sch.fields if f.name == column])
    return read_csv_snapshots(spark, path, only, mandatory=[column]).select(column)
