"""Land a raw profile CSV as Parquet, once.

A CSV with quoted line breaks is cut into records by many tasks:

1. The files are read as lines, by byte ranges. Each line says what it does
   to the state "inside quotes": it may keep, swap or set it. Where no line that
   begins outside quotes ends inside, each is a record and 2 and 3 are left out.
2. One exchange brings the lines of a range together (a range is bounded, as
   Spark's splits are). There a window gives the state before each line for
   either state before the range, and one row a range sums it up.
3. A window over the few ranges of a file gives each range its true state, and
   with it the lines at which records begin. Lines before a range's first record
   go to the last record before.
4. Each record is parsed by Spark's own ``from_csv``. Its fields are counted
   by the same states, so a row with more fields than its header is known.

Everything downstream runs from the landed Parquet. Rows that cannot be used
are kept apart with a reason instead of aborting the load.
"""

from __future__ import annotations

import csv
from collections.abc import Sequence
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rosterlens.functions.text import na_to_null

OVERFLOW = "_overflow"
CORRUPT = "_bad"
STATUS = "_status"
FILE = "_file"
OK = "ok"
PARSE = {"quote": '"', "escape": '"', "mode": "PERMISSIVE", "multiLine": "true"}


def _csv_reader(spark: SparkSession):
    return (
        spark.read.option("header", True)
        .option("multiLine", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("mode", "PERMISSIVE")
    )


def source_files(spark: SparkSession, path: str | list[str]) -> list[str]:
    """The files under ``path`` in path order (a listing: no content is read)."""
    return sorted(spark.read.text(path).inputFiles())


def _open(spark: SparkSession, file: str):
    """A file as a stream of its bytes, decompressed as Spark's scans do it (by the name's ending)."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    at = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(file))
    codec = spark._jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(at)
    stream = at.getFileSystem(conf).open(at)
    return stream if codec is None else codec.createInputStream(stream)


def first_record(spark: SparkSession, file: str, step: int = 4096) -> tuple[str, int]:
    """A file's first record that is not empty and the lines up to its end,
    from as many bytes of the file as that takes."""
    stream = _open(spark, file)
    try:
        data = b""
        while True:
            more = bytes(stream.readNBytes(step))
            data += more
            record, lines = b"", 0
            for line in data.split(b"\n")[:-1 if more else None]:
                record += (b"\n" if record else b"") + line.rstrip(b"\r" if not record else b"")
                lines += 1
                if record and record.count(b'"') % 2 == 0:
                    return record.decode("utf-8", "replace").lstrip("\ufeff").rstrip("\r"), lines
            if len(more) < step:
                return record.decode("utf-8", "replace").lstrip("\ufeff").rstrip("\r"), lines
    finally:
        stream.close()


def file_headers(spark: SparkSession, path: str | list[str]) -> list[tuple[list[str], list[str], int]]:
    """(header columns, files, lines of the header) for each distinct header
    under ``path``, but for empty files. Of each file only the beginning is read,
    several files at once."""
    files = source_files(spark, path)
    with ThreadPool(min(16, max(1, len(files)))) as pool:
        records = pool.map(lambda f: first_record(spark, f), files)
    found: dict[tuple, list[str]] = {}
    for file, (record, lines) in zip(files, records):
        if not record:  # nothing in it
            continue
        found.setdefault((tuple(next(csv.reader([record]), [])), lines), []).append(file)
    return [(list(c), files, n) for (c, n), files in found.items()]


def header_columns(spark: SparkSession, path: str | list[str]) -> list[str]:
    """All columns that some file under ``path`` has, in order of first appearance."""
    return all_columns(file_headers(spark, path))


def all_columns(headers) -> list[str]:
    return list(dict.fromkeys(c for columns, *_ in headers for c in columns))


# ---------------------------------------------------------------- records of lines

# States of the reading between two quotes: 0 outside a quoted field, 1 inside
# one, 2 just behind a quote inside one (which ends it, or is the first of two).


def _behind(state: str, first: str) -> str:
    """The state behind the quote that ends piece p, or at the line's end. A
    quote opens a field only at the field's beginning."""
    return (f"CASE WHEN a.i = size(pieces) - 1 THEN if({state} = 1, 1, 0) WHEN {state} = 1 THEN 2 WHEN {state} = 2 AND p = '' THEN 1 "
            f"WHEN endswith(p, ',') OR ({first} AND p = '') THEN 1 ELSE 0 END")


_COMMAS = "(length({0}) - length(replace({0}, ',', '')))"

#: What a line does to the state and its separators outside quotes: (out,
#: fields) if it begins outside, where a field begins, (inside, fields_in) if inside.
_QUOTING = f"""CASE WHEN contains(value, '"') THEN aggregate(pieces,
  named_struct('out', 0, 'inside', 1, 'fields', 0, 'fields_in', 0, 'i', 0), (a, p) -> named_struct(
    'out', {_behind('a.out', 'a.i = 0')}, 'inside', {_behind('a.inside', 'false')},
    'fields', a.fields + if(a.out = 1, 0, {_COMMAS.format('p')}), 'fields_in', a.fields_in + if(a.inside = 1, 0, {_COMMAS.format('p')}),
    'i', a.i + 1))
  ELSE named_struct('out', 0, 'inside', 1, 'fields', {_COMMAS.format('value')}, 'fields_in', 0, 'i', 1) END"""


def _along(out: str, inside: str, frame: str) -> tuple[str, str, str]:
    """Of the rows before one in a window: the last that sets the state (both its
    ends are one), the number of those that swap it, and from these the state
    before the row if the window begins outside quotes. Where none sets the state, it
    is the other one if the window begins inside."""
    swaps = f"coalesce(sum(if({out} = 1 AND {inside} = 0, 1, 0)) OVER {frame}, 0)"
    at = f"last(if({out} = {inside}, named_struct('to', {out}, 'swaps', swaps), null), true) OVER {frame}"
    return swaps, at, "coalesce((at.to + swaps - at.swaps) % 2, swaps % 2)"


_LINE_FRAME = "(PARTITION BY file, range ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
_RANGE_FRAME = "(PARTITION BY file ORDER BY range ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
_L_SWAPS, _L_AT, _L_STATE = _along("out", "inside", _LINE_FRAME)
_R_SWAPS, _R_AT, _R_STATE = _along("to_0", "to_1", _RANGE_FRAME)

_RECORDS = f"""
WITH placed AS (
  SELECT *, row_number() OVER (PARTITION BY file, range ORDER BY n) - 1L AS k, {_L_SWAPS} AS swaps FROM {{lines}}
), stated AS (
  SELECT *, {_L_STATE} AS s0, if(at IS NULL, 1 - {_L_STATE}, {_L_STATE}) AS s1 FROM (SELECT *, {_L_AT} AS at FROM placed)
), ranges AS (
  -- a range in one row: what it does to the state, and its last beginning of a record, for either state before it; all
  -- columns are read, as for the lines themselves, so that one exchange does for both
  SELECT file, range, max_by(if(s0 = 0, out, inside), n) AS to_0, max_by(if(s1 = 0, out, inside), n) AS to_1,
    max(if(s0 = 0, k, null)) AS last_0, max(if(s1 = 0, k, null)) AS last_1, max(length(value) + fields + fields_in) AS size
  FROM stated GROUP BY file, range
), known AS (
  -- a file begins outside
  SELECT file, range, {_R_STATE} AS first, if({_R_STATE} = 0, last_0, last_1) AS last
  FROM (SELECT *, {_R_AT} AS at FROM (SELECT *, {_R_SWAPS} AS swaps FROM ranges WHERE size >= 0))
), opened AS (
  SELECT file, range, first, last(if(last IS NULL, null, named_struct('range', range, 'k', last)), true) OVER {_RANGE_FRAME} AS open FROM known
), owned AS (
  SELECT /*+ BROADCAST(o) */ s.file, s.range, k, value, open, if(first = 0, s0, s1) AS state,
    if(if(first = 0, s0, s1) = 0, out, inside) AS to, if(if(first = 0, s0, s1) = 0, fields, fields_in) AS commas
  FROM stated s JOIN opened o ON o.file = s.file AND o.range = s.range
), several AS (
  -- the record of a line that is none by itself: the last that began in its range, or before it
  SELECT *, coalesce(last(if(state = 0, named_struct('range', range, 'k', k), null), true) OVER (
    PARTITION BY file, range ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), open) AS of FROM owned
), records AS (
  SELECT file, range, k, value AS record, commas + 1 AS n_fields FROM owned WHERE state = 0 AND to = 0
  UNION ALL
  SELECT file, of.range, of.k, array_join(transform(sort_array(collect_list(struct(range, k, value))), x -> x.value), '\n') AS record,
    sum(commas) + 1 AS n_fields
  FROM several WHERE NOT (state = 0 AND to = 0) GROUP BY file, of
), trimmed AS (
  -- a range of b bytes has b lines at most, so twice its start and the line's number grow along the file
  SELECT file, 2 * range + k AS row, if(endswith(record, '\r'), left(record, length(record) - 1), record) AS record, n_fields
  FROM records WHERE range > 0 OR k >= {{header_lines}}
)
SELECT * FROM trimmed WHERE record <> ''"""


#: Records of files whose every line is one: the lines as they stand, numbered in their range by its first line.
_PLAIN = """
WITH ranges AS (SELECT file, range, min(n) AS first FROM {lines} GROUP BY file, range),
numbered AS (
  SELECT /*+ BROADCAST(r) */ l.file, l.range, n - first AS k, value, q.fields AS commas
  FROM {lines} l JOIN ranges r ON r.file = l.file AND r.range = l.range
), trimmed AS (
  SELECT file, 2 * range + k AS row, if(endswith(value, '\r'), left(value, length(value) - 1), value) AS record, commas + 1 AS n_fields
  FROM numbered WHERE range > 0 OR k >= {header_lines}
)
SELECT * FROM trimmed WHERE record <> ''"""


def _begins_plain(spark: SparkSession, file: str, size: int = 4096) -> bool:
    """Whether quotes are balanced in each whole line of a file's beginning."""
    stream = _open(spark, file)
    try:
        lines = bytes(stream.readNBytes(size)).split(b"\n")[:-1]
    finally:
        stream.close()
    return all(line.count(b'"') % 2 == 0 for line in lines)


def all_plain(spark: SparkSession, lines: DataFrame, files: Sequence[str]) -> bool:
    """Whether each line of the files is a record: none that begins outside
    quotes ends inside. The files are not read for it if one shows a line break
    in quotes in its first bytes, and no further than the first found."""
    with ThreadPool(min(16, max(1, len(files)))) as pool:
        if not all(pool.map(lambda f: _begins_plain(spark, f), files)):
            return False
    return lines.where("q.out <> 0").isEmpty()


def csv_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(value, file, range, n, q): the lines, in which ``n`` grows along a range, and what each does to the state."""
    return (spark.read.option("lineSep", "\n").text(path)
            .selectExpr("value", "_metadata.file_path AS file", "_metadata.file_block_start AS range", "monotonically_increasing_id() AS n",
                        """split(value, '"') AS pieces""")
            .selectExpr("value", "file", "range", "n", f"{_QUOTING} AS q"))


def csv_records(spark: SparkSession, path: str | list[str], header_lines: int = 1) -> DataFrame:
    """(file, row, record, n_fields) of the CSV files, without their headers:
    ``row`` grows along the file, ``record`` may hold line breaks, ``n_fields``
    are its fields, quotes minded. Where each line is a record, nothing is
    exchanged; else the lines are, once."""
    lines = csv_lines(spark, path)
    if all_plain(spark, lines, source_files(spark, path)):
        return spark.sql(_PLAIN, lines=lines, header_lines=header_lines)
    # a task a range, as in the scan: what a task sorts is bounded however many lines there are
    lines = (lines.selectExpr("value", "file", "range", "n", "q.out", "q.inside", "q.fields", "q.fields_in")
             .repartition(max(1, lines.rdd.getNumPartitions()), "file", "range"))
    return spark.sql(_RECORDS, lines=lines, header_lines=header_lines)


def read_profile_csv(spark: SparkSession, path: str | list[str], columns: Sequence[str] | None = None,
                     key: str = "char_id", batch: int = 0, headers=None, by_file: bool = False) -> DataFrame:
    """Scan with an explicit all-string schema (no inference), map the pandas
    NA tokens to null, number rows in source order (``src_ord``) and give
    each row a ``_status``: ``ok``, ``long_row`` (more fields than the
    header; pandas would abort) or ``null_key``.

    Each file is read by its own header: columns go by name, a column that a
    file lacks is null there. ``src_ord`` is (batch, file, row): files by path,
    rows growing as they stand in the file, whatever the files' sizes.

    ``headers`` (of ``file_headers``) saves reading them again. Lines end in
    ``\\n`` or ``\\r\\n``. ``by_file`` reads each file by one task of Spark's
    multi-line scan instead, which also knows files of ``\\r`` alone; it sees no
    long row whose one extra field is empty beside another empty field.
    """
    headers = file_headers(spark, path) if headers is None else headers
    columns = list(columns) if columns is not None else all_columns(headers)
    parts = []
    for header, files, lines in headers:
        source = files
        if by_file:
            raw = _csv_reader(spark).schema(scan_schema(header)).option("columnNameOfCorruptRecord", CORRUPT).csv(source)
            long_row = F.col(OVERFLOW).isNotNull() | F.col(CORRUPT).isNull()
            # a multi-line file is read by one task from its start, so ids grow along it
            raw = raw.select("*", F.col("_metadata.file_path").alias(FILE), F.monotonically_increasing_id().alias("_row"),
                             long_row.alias("_long"))
        else:
            fields = F.from_csv("record", _ddl(header), PARSE)
            raw = csv_records(spark, source, lines).select(
                F.col("file").alias(FILE), F.col("row").alias("_row"), (F.col("n_fields") > len(header)).alias("_long"),
                fields.alias("_fields")).select(FILE, "_row", "_long", "_fields.*")
        raw = raw.withColumns({c: F.lit(None).cast("string") for c in columns if c not in header})
        parts.append(flag_rows(raw, columns, key, batch))
    if not parts:
        return spark.createDataFrame([], landed_schema(columns))
    return reduce(DataFrame.unionByName, parts)


def _ddl(columns: Sequence[str]) -> str:
    return ", ".join("`" + c.replace("`", "``") + "` string" for c in columns)


def scan_schema(columns: Sequence[str]) -> T.StructType:
    """All header columns as strings, one overflow column, the corrupt-record column."""
    return T.StructType(
        [T.StructField(c, T.StringType()) for c in columns]
        + [T.StructField(OVERFLOW, T.StringType()), T.StructField(CORRUPT, T.StringType())]
    )


def landed_schema(columns: Sequence[str]) -> T.StructType:
    """What a scan gives: the columns, ``src_ord`` and ``_status``."""
    order = T.StructType([T.StructField("batch", T.LongType()), T.StructField("file", T.StringType()),
                          T.StructField("row", T.LongType())])
    return T.StructType([*(T.StructField(c, T.StringType()) for c in columns), T.StructField("src_ord", order),
                         T.StructField(STATUS, T.StringType())])


def flag_rows(raw: DataFrame, columns: Sequence[str], key: str, batch: int) -> DataFrame:
    """NA tokens -> null, ``src_ord``, ``_status`` (see read_profile_csv)."""
    status = F.when(F.col("_long"), F.lit("long_row")).when(na_to_null(F.col(key)).isNull(), F.lit("null_key")).otherwise(F.lit(OK))
    order = F.struct(F.lit(batch).cast("long").alias("batch"), F.col(FILE).alias("file"), F.col("_row").alias("row"))
    return raw.select(
        *[na_to_null(F.col(c)).alias(c) for c in columns],
        order.alias("src_ord"),
        status.alias(STATUS),
    )


BATCH = "landed_batch"


def land_csv(spark: SparkSession, path: str | list[str], out: str, columns: Sequence[str] | None = None,
             key: str = "char_id", headers=None) -> str:
    """One pass: scan, flag, write Parquet partitioned by ``_status`` so the
    usable rows and the quarantine come from the same read."""
    rows = read_profile_csv(spark, path, columns, key, headers=headers)
    rows.withColumn(BATCH, F.lit(0)).write.mode("overwrite").partitionBy(BATCH, STATUS).parquet(out, compression="zstd")
    return out


def read_landed(spark: SparkSession, out: str, status: str = OK, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows of one status (partition pruning reads only that folder). With
    ``columns`` the schema is given, so a landing without rows reads as empty."""
    reader = spark.read
    if columns is not None:
        reader = reader.schema(landed_schema(columns).add(BATCH, T.IntegerType()))
    return reader.parquet(out).where(F.col(STATUS) == status).drop(STATUS, BATCH)


def sample_rows(df: DataFrame, n: int | None, order: Sequence[str] = ("src_ord",)) -> DataFrame:
    """The first ``n`` rows in source order (all rows when n is None)."""
    if n is None:
        return df
    return df.orderBy(*order).limit(n)


def first_files(spark: SparkSession, path: str | list[str], n: int, key: str = "char_id") -> list[str]:
    """As many files, from the first in path order, as hold ``n`` usable rows:
    one, then twice as many each time, so that the rest is not read."""
    files = source_files(spark, path)
    take, found = 1, 0
    done = 0
    while done < len(files) and found < n:
        part = read_profile_csv(spark, files[done:take], key=key)
        found += part.where(F.col(STATUS) == OK).limit(n - found).count()
        done, take = take, 2 * take
    return files[:done] or files


FILE_ROWS = 250_000


def write_profile_csv(df: DataFrame, path: str) -> str:
    """Write rows as CSV the way the reader above expects: header, RFC 4180
    quoting (quotes doubled), white space kept, null as an empty field. Files are
    compressed, so each is read by one task, and hold ``FILE_ROWS`` rows at most."""
    (
        df.write.mode("overwrite")
        .option("compression", "gzip")
        .option("maxRecordsPerFile", FILE_ROWS)
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
    return path
