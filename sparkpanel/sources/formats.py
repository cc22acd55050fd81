"""Pluggable sources by name (X4) and two file forms that Spark has no reader for.

``register_formats(spark)`` registers the Python data sources of this module, after which
``spark.read.format("code_sheet").schema(...).load(folder)`` reads workbooks (``.xlsx``) like
any other source.  Further sources are ``DataSource`` classes added to ``FORMATS``.

``feature_collection`` reads one large JSON document of features by byte ranges.  Whether a
byte is inside a text, and how deep it is nested, depends on everything before it; so every
range is scanned first for what it does to that state, whatever the state is at its start.
These effects compose, which gives each range its start state, and then every range
reads the features that start inside it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import BooleanType, DoubleType, FloatType, IntegralType, StringType, StructField, StructType

from sparkpanel.session import scratch_path
from sparkpanel.sources.files import resolve_path, list_files, register_source

_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"


# ---------------------------------------------------------------- workbooks

def _column(reference: str) -> int:
    """0-based column of a cell reference such as ``AB12``."""
    n = 0
    for c in reference:
        if not c.isalpha():
            break
        n = n * 26 + ord(c.upper()) - 64
    return n - 1


def _sheet_member(archive, wanted: str | None) -> str:
    """Path inside the workbook of the sheet with this name; the first sheet without a name."""
    from xml.etree import ElementTree as T

    targets = {r.get("Id"): r.get("Target") for r in T.fromstring(archive.read("xl/_rels/workbook.xml.rels"))}
    sheets = [(s.get("name"), targets[s.get(f"{_REL}id")]) for s in T.fromstring(archive.read("xl/workbook.xml")).iter(f"{_MAIN}sheet")]
    found = [t for n, t in sheets if wanted in (None, "", n)]
    if not found:
        raise ValueError(f"no sheet {wanted!r} among {[n for n, _ in sheets]}")
    return found[0].lstrip("/") if found[0].startswith("/") else f"xl/{found[0]}"


def sheet_rows(path: str, sheet: str | None = None) -> Iterator[list[str | None]]:
    """The rows of a workbook's sheet as texts, read as a stream; empty cells are None, blank rows empty lists."""
    import zipfile
    from xml.etree import ElementTree as T

    filesystem, inside = resolve_path(path)
    with filesystem.open_input_file(inside) as stream, zipfile.ZipFile(stream) as archive:
        shared = []
        if "xl/sharedStrings.xml" in archive.namelist():
            with archive.open("xl/sharedStrings.xml") as f:
                for _, e in T.iterparse(f):
                    if e.tag == f"{_MAIN}si":
                        shared.append("".join(t.text or "" for t in e.iter(f"{_MAIN}t")))
                        e.clear()
        with archive.open(_sheet_member(archive, sheet)) as f:
            for _, e in T.iterparse(f):
                if e.tag != f"{_MAIN}row":
                    continue
                row: list[str | None] = []
                for n, c in enumerate(e.iter(f"{_MAIN}c")):
                    at = _column(c.get("r")) if c.get("r") else n
                    row += [None] * (at + 1 - len(row))
                    value = c.findtext(f"{_MAIN}v")
                    if c.get("t") == "inlineStr":
                        value = "".join(t.text or "" for t in c.iter(f"{_MAIN}t"))
                    elif c.get("t") == "s" and value is not None:
                        value = shared[int(value)]
                    row[at] = value or None
                e.clear()
                yield row


def _typed(value: str | None, kind):
    """A cell's text in the column's type; texts that do not fit are null."""
    if value is None or isinstance(kind, StringType):
        return value
    try:
        if isinstance(kind, IntegralType):
            number = float(value)
            return int(value) if re.fullmatch(r"[+-]?\d+", value) else int(number) if number.is_integer() else None
        if isinstance(kind, (DoubleType, FloatType)):
            return float(value)
        if isinstance(kind, BooleanType):
            return {"1": True, "true": True, "0": False, "false": False}.get(value.lower())
    except (ValueError, OverflowError):
        return None
    raise ValueError(f"unsupported column type {kind.simpleString()}")


class _Workbook(InputPartition):
    def __init__(self, path: str):
        super().__init__(path)


class _SheetReader(DataSourceReader):
    def __init__(self, schema: StructType, path: str, sheet: str | None):
        self.schema, self.path, self.sheet = schema, path, sheet

    def partitions(self):
        return [_Workbook(p) for p in _workbooks(self.path)]

    def read(self, partition):
        rows = sheet_rows(partition.value, self.sheet)
        header = next(rows, [])
        place = {name.strip().lower(): i for i, name in reversed(list(enumerate(header))) if name}
        missing = [f.name for f in self.schema.fields if f.name.lower() not in place]
        if missing:
            raise ValueError(f"{partition.value}: no column {missing} in {header}")
        at = [(place[f.name.lower()], f.dataType) for f in self.schema.fields]
        for row in rows:
            if any(v is not None for v in row):
                yield tuple(_typed(row[i] if i < len(row) else None, kind) for i, kind in at)


def _workbooks(path: str) -> list[str]:
    from pyarrow import fs

    filesystem, inside = resolve_path(path)
    return [path] if filesystem.get_file_info(inside).type == fs.FileType.File else list_files(path, ".xlsx")


class CodeSheetSource(DataSource):
    """``format("code_sheet")``: rows of workbooks, columns by header name whatever their order.

    Path: one workbook or a folder; one partition per workbook, read as a stream.  Option
    ``sheet``: a sheet's name, the first one by default.  Schema: the given one (texts that do
    not fit a type are null), else the first workbook's header, all strings.  Blank rows are
    skipped; a workbook without one of the columns fails.
    """

    @classmethod
    def name(cls):
        return "code_sheet"

    def schema(self):
        books = _workbooks(self.options["path"])
        header = next(sheet_rows(books[0], self.options.get("sheet")), []) if books else []
        return StructType([StructField(n.strip(), StringType()) for n in header if n])

    def reader(self, schema):
        return _SheetReader(schema, self.options["path"], self.options.get("sheet"))


FORMATS: list[type[DataSource]] = [CodeSheetSource]


def register_formats(spark: SparkSession) -> None:
    """Make the data sources of FORMATS available to ``spark.read.format(name)``."""
    for source in FORMATS:
        spark.dataSource.register(source)


@register_source("code_sheet")
def read_code_sheet(spark: SparkSession, path: str, schema: StructType | str | None = None, **options) -> DataFrame:
    """S9 through the registry of readers."""
    register_formats(spark)
    r = spark.read.format("code_sheet").options(**options)
    return (r.schema(schema) if schema is not None else r).load(path)


def write_code_sheets(df: DataFrame, path: str, sheet: str = "codes") -> DataFrame:
    """One workbook per partition of ``df`` in the shared folder ``path``, numbers as numbers, all else as text.

    Rows are streamed into the archive; a finished workbook is moved into place.  Returns the manifest (path, n_rows).
    """
    names, numeric = df.columns, [f.dataType.typeName() in ("byte", "short", "integer", "long", "float", "double") for f in df.schema.fields]

    def pack(batches):
        import uuid
        import zipfile
        from xml.sax.saxutils import escape

        from pyspark import TaskContext

        filesystem, folder = resolve_path(path)
        filesystem.create_dir(folder, recursive=True)
        name = f"part-{TaskContext.get().partitionId():05d}.xlsx"
        draft, n = f"{folder}/.{name}-{uuid.uuid4().hex}", 0
        main, rel = _MAIN[1:-1], _REL[1:-1]

        def cells(values, kinds):
            return "".join("<c/>" if v == "" else f"<c><v>{v}</v></c>" if k else f'<c t="inlineStr"><is><t xml:space="preserve">{escape(v)}</t></is></c>'
                           for v, k in zip(values, kinds))

        with filesystem.open_output_stream(draft) as stream, zipfile.ZipFile(stream, "w", zipfile.ZIP_DEFLATED) as archive:
            archive.writestr("xl/workbook.xml", f'<workbook xmlns="{main}" xmlns:r="{rel}"><sheets><sheet name="{escape(sheet)}" sheetId="1" r:id="r1"/></sheets></workbook>')
            archive.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
                             f'<Relationship Id="r1" Type="{rel}/worksheet" Target="worksheets/sheet1.xml"/></Relationships>')
            with archive.open("xl/worksheets/sheet1.xml", "w") as f:
                f.write(f'<worksheet xmlns="{main}"><sheetData><row>{cells(names, [False] * len(names))}</row>'.encode())
                for pdf in batches:
                    for row in pdf.itertuples(index=False, name=None):
                        f.write(f"<row>{cells(row, numeric)}</row>".encode())
                        n += 1
                f.write(b"</sheetData></worksheet>")
        filesystem.move(draft, f"{folder}/{name}")
        yield pd.DataFrame([(f"{path.rstrip('/')}/{name}", n)], columns=["path", "n_rows"])

    text = df.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(c) for c in names])
    text.mapInPandas(pack, "path string, n_rows long").write.parquet(f"{path.rstrip('/')}/_manifest")
    return df.sparkSession.read.schema("path string, n_rows long").parquet(f"{path.rstrip('/')}/_manifest")


# ---------------------------------------------------------------- feature collections

_MARK = re.compile(rb'[\\"{}\[\]]')
#: states a range can start in: outside a text, inside one, inside one right after a backslash
OUTSIDE, INSIDE, ESCAPED = range(3)
_BLOCK = 1 << 20


class _State:
    """Text state and depth of a scan; ``step`` takes one mark of the document."""

    __slots__ = ("text", "depth", "skip")

    def __init__(self, text: int, depth: int, at: int):
        self.text, self.depth, self.skip = text != OUTSIDE, depth, at if text == ESCAPED else -1

    def step(self, mark: int, at: int) -> int:
        """The change of depth at this mark (0 inside texts)."""
        if at == self.skip:
            return 0
        if self.text:
            if mark == 0x5C:
                self.skip = at + 1
            elif mark == 0x22:
                self.text = False
            return 0
        if mark == 0x22:
            self.text = True
            return 0
        change = 1 if mark in b"{[" else -1 if mark in b"}]" else 0
        self.depth += change
        return change

    def at_end(self, end: int) -> int:
        return OUTSIDE if not self.text else ESCAPED if self.skip == end else INSIDE


def _read(filesystem, inside: str, start: int, end: int | None) -> Iterator[tuple[int, bytes]]:
    """(place, bytes) blocks of a file from ``start`` to ``end`` (None: to the end of the file)."""
    with filesystem.open_input_file(inside) as f:
        f.seek(start)
        while end is None or start < end:
            block = f.read(_BLOCK if end is None else min(_BLOCK, end - start))
            if not block:
                return
            yield start, block
            start += len(block)


def _effects(batches):
    """Per range and start state: the state at its end and the change of depth."""
    for pdf in batches:
        rows = []
        for path, start, end in zip(pdf["path"], pdf["start"], pdf["end"]):
            filesystem, inside = resolve_path(path)
            states = [_State(s, 0, start) for s in (OUTSIDE, INSIDE, ESCAPED)]
            for at, block in _read(filesystem, inside, start, end):
                for m in _MARK.finditer(block):
                    for s in states:
                        s.step(block[m.start()], at + m.start())
            rows.append((path, start, end, [s.at_end(end) for s in states], [s.depth for s in states]))
        yield pd.DataFrame(rows, columns=["path", "start", "end", "states", "depths"])


def _key_before(filesystem, inside: str, at: int) -> str | None:
    """The name whose value starts at ``at``; names longer than 4,000 bytes are no name."""
    low = max(0, at - 4096)
    before = b"".join(b for _, b in _read(filesystem, inside, low, at))
    m = re.search(rb'"((?:[^"\\]|\\.)*)"\s*:\s*$', before)
    return m[1].decode("utf-8", "replace") if m else None


def _features(batches):
    """Arrays directly inside the document and objects directly inside such an array, that start in the range.

    An object that starts in the range is read to its end, beyond the range if need be.
    """
    for pdf in batches:
        for path, start, end, text, depth in zip(pdf["path"], pdf["start"], pdf["end"], pdf["text"], pdf["depth"]):
            filesystem, inside = resolve_path(path)
            state, open_at, held, rows, done = _State(int(text), int(depth), start), None, [], [], False
            for at, block in _read(filesystem, inside, start, None):
                cut = 0
                for m in _MARK.finditer(block):
                    place = at + m.start()
                    if place >= end and open_at is None:
                        done = True
                        break
                    change = state.step(block[m.start()], place)
                    if change > 0 and state.depth == 2 and block[m.start()] == 0x5B and place < end:
                        rows.append((path, place, "array", _key_before(filesystem, inside, place)))
                    elif change > 0 and state.depth == 3 and block[m.start()] == 0x7B:
                        open_at, cut = place, m.start()
                    elif change < 0 and state.depth == 2 and open_at is not None:
                        held.append(block[cut:m.end()])
                        rows.append((path, open_at, "object", b"".join(held).decode("utf-8")))
                        open_at, held = None, []
                        if len(rows) >= 500:
                            yield pd.DataFrame(rows, columns=["path", "place", "kind", "value"])
                            rows = []
                if open_at is not None:
                    held.append(block[cut:])
                if done or (open_at is None and at + len(block) >= end):
                    break
            if open_at is not None:
                raise ValueError(f"{path}: the object at byte {open_at} does not end")
            yield pd.DataFrame(rows, columns=["path", "place", "kind", "value"])


@register_source("feature_collection")
def feature_collection(spark: SparkSession, path: str, array: str = "features", range_bytes: int = 64 << 20, suffix: str = ".json") -> DataFrame:
    """(path, place, feature): the objects of the document's array ``array`` as JSON texts, with their byte offset.

    Path: one document or a folder of them.  Every range of ``range_bytes`` is a task, so one
    large document is many.  Per range one row (five numbers) comes to the driver.  Objects in
    other arrays, nested arrays and values that are no objects are left out; a document
    without the array has no rows; an object cut off by the end of the file fails.
    """
    from pyarrow import fs

    filesystem, inside = resolve_path(path)
    info = filesystem.get_file_info(inside)
    found = [path] if info.type == fs.FileType.File else list_files(path, suffix)
    ranges = [(p, a, min(size, a + range_bytes)) for p in found for size in [filesystem.get_file_info(resolve_path(p)[1]).size]
              for a in range(0, size, range_bytes)]
    if not ranges:
        return spark.createDataFrame([], "path string, place long, feature string")
    listed = spark.createDataFrame(ranges, "path string, start long, end long").repartition(min(len(ranges), 4096))
    effects = {(r["path"], r["start"]): r for r in listed.mapInPandas(
        _effects, "path string, start long, end long, states array<int>, depths array<int>").collect()}
    known, text, depth = [], OUTSIDE, 0
    for p, a, b in ranges:
        if a == 0:
            text, depth = OUTSIDE, 0
        known.append((p, a, b, text, depth))
        e = effects[p, a]
        text, depth = e["states"][text], depth + e["depths"][text]
    out = scratch_path(spark, "features")
    spark.createDataFrame(known, "path string, start long, end long, text int, depth int").repartition(min(len(ranges), 4096)) \
        .mapInPandas(_features, "path string, place long, kind string, value string").write.parquet(out)
    rows = spark.read.schema("path string, place long, kind string, value string").parquet(out)
    # the arrays of a document are as many as its own names: one row per document
    arrays = rows.where("kind = 'array'").groupBy("path").agg(F.array_sort(F.collect_list(F.struct("place", "value"))).alias("arrays"))
    last = F.element_at(F.filter("arrays", lambda a: a["place"] < F.col("place")), -1)["value"]
    return rows.where("kind = 'object'").join(arrays, "path").where(last == array).select("path", "place", F.col("value").alias("feature"))
