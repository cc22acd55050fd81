"""File sources and sinks (S1-S19) and the source-reader registry.

Readers take explicit schemas (no inference pass over the data).  Per-file
metadata comes from the ``_metadata`` column; file footers and headers are
read by tasks (``mapInPandas`` over a table of file paths), never by a driver
loop over data.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

# ---------------------------------------------------------------- registry

SOURCE_READERS: dict[str, Callable[..., DataFrame]] = {}


def register_source(name: str):
    """Register a reader ``(spark, path, **options) -> DataFrame`` under a name."""

    def deco(fn):
        SOURCE_READERS[name] = fn
        return fn

    return deco


def read_source(spark: SparkSession, name: str, path: str, **options) -> DataFrame:
    if name not in SOURCE_READERS:
        raise KeyError(f"no reader registered for {name!r}")
    return SOURCE_READERS[name](spark, path, **options)


# ---------------------------------------------------------------- CSV

@register_source("csv")
def read_csv(spark: SparkSession, path, schema: StructType | str, header: bool = True, encoding: str = "UTF-8",
             mode: str = "PERMISSIVE", **options) -> DataFrame:
    """CSV with an explicit schema.

    A UTF-8 byte-order mark on the first header name is tolerated (S5); rows with
    an extra trailing field keep their columns aligned under an explicit schema
    (``mode='FAILFAST'`` raises instead, the header-shift guard of D10).
    """
    r = spark.read.schema(schema).option("header", header).option("encoding", encoding).option("mode", mode)
    for k, v in options.items():
        r = r.option(k, v)
    return r.csv(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", header: bool = True) -> None:
    """CSV sink (S5/S18: ``mode='append'`` for page-by-page appends)."""
    df.write.mode(mode).option("header", header).csv(path)


def resolve_path(path: str):
    """(pyarrow filesystem, path inside it) for local paths and scheme://authority/... URIs."""
    from pyarrow import fs

    if "://" not in path or path.startswith("file:"):
        return fs.LocalFileSystem(), path.removeprefix("file://").removeprefix("file:")
    scheme, rest = path.split("://", 1)
    authority, _, inner = rest.partition("/")
    filesystem, _ = fs.FileSystem.from_uri(f"{scheme}://{authority}/")
    return filesystem, (f"{authority}/{inner}" if scheme in ("s3", "gs", "abfs") else "/" + inner)


def _plain(path: str) -> str:
    """A local path without its ``file:`` scheme, for comparing the two spellings."""
    return path.removeprefix("file://").removeprefix("file:")


def list_files(path: str, suffix: str = "") -> list[str]:
    """File listing (metadata only) through pyarrow's filesystem layer (local, HDFS, object stores)."""
    from pyarrow import fs

    filesystem, root = resolve_path(path)
    infos = filesystem.get_file_info(fs.FileSelector(root, recursive=True))
    scheme = path.split("://")[0] + "://" if "://" in path else ""
    return sorted(scheme + i.path for i in infos if i.type == fs.FileType.File and i.path.endswith(suffix)
                  and not i.base_name.startswith(("_", ".")))


def _first_record(stream) -> list[str]:
    """Field names of a CSV stream's first record, however long it is (quoted names may hold commas and breaks)."""
    import csv
    import io

    text = io.TextIOWrapper(stream, encoding="utf-8-sig", errors="replace", newline="")
    return next(csv.reader(text), [])


def _headers(batches):
    for pdf in batches:
        out = []
        for p in pdf["path"]:
            filesystem, root = resolve_path(p)
            with filesystem.open_input_stream(root) as f:
                out.append(_first_record(f))
        yield pd.DataFrame({"path": pdf["path"], "header": out})


def csv_headers(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(path, header array<string>) of every file, read by tasks."""
    df = spark.createDataFrame([(p,) for p in paths], "path string")
    return df.repartition(max(1, min(len(paths), 256))).mapInPandas(_headers, "path string, header array<string>")


def read_csv_files_with_column(spark: SparkSession, folder: str, required: str, schema: StructType | str, skip_names=(),
                               suffix: str = ".csv") -> DataFrame:
    """Every CSV under ``folder`` that has column ``required``, skipping own outputs.

    Columns are taken by NAME: files are grouped by their header, each group is read in its
    own column order, and the groups are united by name; a column of ``schema`` that a file
    lacks is null.  Adds ``source_file`` and ``source_path``.  No matching file: an empty
    frame with the same columns.
    """
    # skip_names: path fragments of files to leave out (e.g. the job's own earlier output folder)
    wanted = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    kinds = {f.name: f.dataType for f in wanted.fields}
    files = [p for p in list_files(folder, suffix) if not any(s in p for s in skip_names)]
    groups: dict[tuple, list[str]] = {}
    if files:
        for r in csv_headers(spark, files).where(F.array_contains("header", required)).collect():
            groups.setdefault(tuple(r["header"]), []).append(r["path"])
    empty = StructType(wanted.fields + [StructField("source_file", StringType()), StructField("source_path", StringType())])
    out = spark.createDataFrame([], empty)
    for header, paths in sorted(groups.items()):
        own = StructType()
        for i, name in enumerate(header):
            first = name in kinds and name not in header[:i]
            own = own.add(name if first else f"__{i}", kinds[name] if first else StringType())
        part = read_csv(spark, sorted(paths), own, multiLine=True)
        part = part.select(*[(F.col(f"`{c}`") if c in header else F.lit(None)).cast(t).alias(c) for c, t in kinds.items()],
                           F.col("_metadata.file_name").alias("source_file"), F.col("_metadata.file_path").alias("source_path"))
        out = out.unionByName(part)
    return out


def merge_part_files(spark: SparkSession, template: str, pages: range, schema) -> DataFrame:
    """S3: header-once concat of numbered page files; missing pages are tolerated.

    Only the folder that holds the pages (the template up to its last ``/`` before the page
    number) is listed, once.
    """
    existing = list_files(template[:template.index("{")].rsplit("/", 1)[0])
    wanted = [_plain(template.format(page=i)).rstrip("/") for i in pages]
    paths = [f for f in existing if any(_plain(f) == p or _plain(f).startswith(p + "/") for p in wanted)]
    return read_csv(spark, paths, schema) if paths else spark.createDataFrame([], schema)


# ---------------------------------------------------------------- Parquet

def narrow_types(df: DataFrame) -> DataFrame:
    """Every whole-number column cast to the smallest type that holds its values (one aggregation)."""
    whole = [f.name for f in df.schema.fields if f.dataType.typeName() in ("short", "integer", "long")]
    if not whole:
        return df
    row = df.agg(*[F.struct(F.min(c).alias("lo"), F.max(c).alias("hi")).alias(c) for c in whole]).first()

    def fit(lo, hi, own):
        for name, bits in (("tinyint", 7), ("smallint", 15), ("int", 31)):
            if lo is not None and -(1 << bits) <= lo and hi < 1 << bits:
                return name
        return own

    kinds = {c: fit(row[c]["lo"], row[c]["hi"], df.schema[c].dataType.simpleString()) for c in whole}
    return df.select(*[F.col(f"`{c}`").cast(kinds[c]).alias(c) if c in kinds else F.col(f"`{c}`") for c in df.columns])


def typed_append(df: DataFrame, path: str, schema: StructType | str) -> None:
    """Append records of text fields to a typed table; a value that does not parse becomes NULL."""
    kinds = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    df.select(*[(F.col(f"`{f.name}`").try_cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType)).alias(f.name)
                for f in kinds.fields]).write.mode("append").parquet(path)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", partition_by: list[str] | None = None,
                  compression: str = "snappy", narrow: bool = False) -> None:
    """Parquet sink (snappy), optionally partitioned for later pruning and with narrowed types."""
    w = (narrow_types(df) if narrow else df).write.mode(mode).option("compression", compression)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def _footers(batches):
    import pyarrow.parquet as pq

    for pdf in batches:
        rows = []
        for p in pdf["path"]:
            filesystem, root = resolve_path(p)
            with filesystem.open_input_file(root) as f:
                md = pq.read_metadata(f)
                size = f.size()
            rows.append((p, md.num_rows, md.num_columns, md.num_row_groups, str(md.format_version), size))
        yield pd.DataFrame(rows, columns=["path", "num_rows", "num_columns", "num_row_groups", "format_version",
                                          "size_bytes"])


def parquet_footers(spark: SparkSession, path: str) -> DataFrame:
    """Rows, columns, row groups, format version and size per Parquet file.

    The file list is metadata; footers are read by tasks (``mapInPandas``).
    """
    from pyarrow import fs

    filesystem, root = resolve_path(path)
    folder = filesystem.get_file_info(root).type == fs.FileType.Directory  # Spark names its folders x.parquet too
    files = list_files(path, ".parquet") if folder else [path]
    df = spark.createDataFrame([(p,) for p in files], "path string")
    return df.repartition(max(1, min(len(files), 256))).mapInPandas(
        _footers, "path string, num_rows long, num_columns long, num_row_groups long, format_version string, size_bytes long")


def lookup_partition(spark: SparkSession, path: str, column: str, value) -> DataFrame:
    """Parameterised read ``... WHERE column = :v`` of a partitioned table (partition pruning)."""
    return spark.read.parquet(path).where(F.col(f"`{column}`") == F.lit(value))


# ---------------------------------------------------------------- JSON

def append_json_landing(df: DataFrame, path: str) -> None:
    """Append raw JSON records with their landing time."""
    df.withColumn("scraped_at", F.current_timestamp()).write.mode("append").parquet(path)


def read_json_lines(spark: SparkSession, path, schema, multi_line: bool = False) -> DataFrame:
    """JSON with an explicit schema (multi-line documents such as feature collections)."""
    return spark.read.schema(schema).option("multiLine", multi_line).json(path)


def write_json_by(df: DataFrame, path: str, key: str) -> None:
    """One JSON folder per key value."""
    df.write.mode("overwrite").partitionBy(key).json(path)


register_source("parquet")(lambda spark, path, **o: spark.read.options(**o).parquet(path))
register_source("json")(lambda spark, path, schema=None, **o: (spark.read.schema(schema) if schema else spark.read).options(**o).json(path))


# ---------------------------------------------------------------- zipped CSV

#: most tasks that the members of all archives are dealt to
MEMBER_TASKS = 2000


def _open_archive(path: str):
    """(stream, archive): the central directory is read by seeks, members only when they are opened."""
    import zipfile

    filesystem, inside = resolve_path(path)
    stream = filesystem.open_input_file(inside)
    return stream, zipfile.ZipFile(stream)


def _members(batches):
    """One row per CSV member of the archives: path, member, its place in the directory and its unpacked bytes."""
    for pdf in batches:
        rows = []
        for path in pdf["path"]:
            stream, archive = _open_archive(path)
            with stream, archive:
                rows += [(path, info.filename, i, info.file_size) for i, info in enumerate(archive.infolist())
                         if not info.is_dir() and info.filename.lower().endswith(".csv")]
        yield pd.DataFrame(rows, columns=["path", "member", "place", "size_bytes"])


def _member_records(batches):
    """The records of each member, unpacked as a stream in blocks.

    Members are decoded as UTF-8 and read again as CP949 (the Korean code page) if that
    fails.  Records are parsed as CSV, so a quoted field may hold line breaks.
    """
    import csv
    import io

    def encoding_of(archive, info):
        try:
            with io.TextIOWrapper(archive.open(info), encoding="utf-8-sig") as f:
                while f.read(1 << 20):
                    pass
            return "utf-8-sig"
        except UnicodeDecodeError:
            return "cp949"

    for pdf in batches:
        for path, place in zip(pdf["path"], pdf["place"]):
            stream, archive = _open_archive(path)
            with stream, archive:
                info = archive.infolist()[place]
                with io.TextIOWrapper(archive.open(info), encoding=encoding_of(archive, info), newline="") as f:
                    rows = []
                    for i, fields in enumerate(csv.reader(f)):
                        rows.append((path, info.filename, i, fields))
                        if len(rows) >= 5000:
                            yield pd.DataFrame(rows, columns=["path", "member", "record_no", "fields"])
                            rows = []
                    if rows:
                        yield pd.DataFrame(rows, columns=["path", "member", "record_no", "fields"])


def zip_members(spark: SparkSession, path: str) -> DataFrame:
    """(path, member, place, size_bytes) of every CSV member of the archive at ``path`` or of all in that folder."""
    from pyarrow import fs

    filesystem, inside = resolve_path(path)
    archives = [path] if filesystem.get_file_info(inside).type == fs.FileType.File else list_files(path, ".zip")
    df = spark.createDataFrame([(p,) for p in archives], "path string")
    return df.repartition(max(1, min(len(archives), 256))).mapInPandas(_members, "path string, member string, place int, size_bytes long")


def read_zipped_csv(spark: SparkSession, path: str, schema: StructType | str, header: bool = True) -> DataFrame:
    """CSV members of zip archives, columns by position.

    The unit of work is a member, not an archive: tasks read the central directories by seeks,
    the list of members is dealt out, and each is unpacked as a stream, so neither an archive
    nor a member is ever held whole.  Empty and unparsable fields are NULL; blank records are
    skipped.
    """
    from sparkpanel.session import scratch_path

    kinds = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    listed = scratch_path(spark, "members")
    zip_members(spark, path).write.parquet(listed)
    members = spark.read.schema("path string, member string, place int, size_bytes long").parquet(listed)
    n = max(1, min(members.count(), MEMBER_TASKS))
    # one member to a task: numbers are hashed apart, so big archives do not keep their members together
    dealt = members.repartition(n)
    records = dealt.mapInPandas(_member_records, "path string, member string, record_no long, fields array<string>")
    records = records.where(F.size("fields") > 0)
    if header:
        records = records.where(F.col("record_no") > 0)
    return records.select(*[F.nullif(F.get("fields", F.lit(i)), F.lit("")).try_cast(f.dataType).alias(f.name)
                            for i, f in enumerate(kinds.fields)])


def write_zipped_csv(df: DataFrame, path: str, rows_per_member: int = 5000, encoding: str = "utf-8") -> DataFrame:
    """S4 sink: one archive per partition of ``df`` in the shared folder ``path``, of CSV members of ``rows_per_member``
    records with a header each.  Returns the written manifest (path, member, n_rows).

    A task writes under a name of its own and moves the finished archive into place, so a
    repeated attempt leaves one whole archive.  Null fields are empty.
    """
    names = df.columns

    def pack(batches):
        import csv
        import io
        import uuid
        import zipfile

        from pyspark import TaskContext

        filesystem, folder = resolve_path(path)
        filesystem.create_dir(folder, recursive=True)
        name = f"part-{TaskContext.get().partitionId():05d}"
        draft = f"{folder}/.{name}-{uuid.uuid4().hex}"
        manifest, held = [], []

        def flush(archive):
            out = io.StringIO()
            csv.writer(out).writerows([names, *held])
            member = f"{name}-{len(manifest):03d}.csv"
            archive.writestr(member, out.getvalue().encode(encoding))
            manifest.append((f"{path.rstrip('/')}/{name}.zip", member, len(held)))
            held.clear()

        with filesystem.open_output_stream(draft) as stream:
            with zipfile.ZipFile(stream, "w", zipfile.ZIP_DEFLATED) as archive:
                for pdf in batches:
                    for row in pdf.itertuples(index=False, name=None):
                        held.append(row)
                        if len(held) == rows_per_member:
                            flush(archive)
                if held:
                    flush(archive)
        if manifest:
            filesystem.move(draft, f"{folder}/{name}.zip")
        else:
            filesystem.delete_file(draft)
        yield pd.DataFrame(manifest, columns=["path", "member", "n_rows"])

    text = df.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(c) for c in names])
    text.mapInPandas(pack, "path string, member string, n_rows long").write.parquet(f"{path.rstrip('/')}/_manifest")
    return df.sparkSession.read.schema("path string, member string, n_rows long").parquet(f"{path.rstrip('/')}/_manifest")


register_source("zipped_csv")(read_zipped_csv)
