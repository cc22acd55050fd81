"""Records from repeated blocks of a page (H7): one page gives n records of several fields.

A page is read once as a stream of tags and texts by a scanner that keeps the open elements;
``Selector`` and ``Field`` say which element is a record and which elements inside it are
its fields.  Nesting is why this is not a regular expression: a field's text may hold
further elements of the same name, and blocks of the same name may be nested.  Tasks read
Arrow batches of pages; a page's records leave as rows, so nothing is gathered.

Malformed markup has one defined reading:

* comments, doctypes and the insides of ``script`` and ``style`` are no text;
* void elements (``br``, ``img``, ...) and tags that end in ``/>`` never stay open;
* an end tag closes the innermost open element of its name and all inside it; without one it is ignored;
* a new ``li``, ``p``, ``tr``, ``td``, ... ends an open one of its kind, unless a container stands between them;
* at the end of the page everything open is closed; a ``<`` that starts no tag is text.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: fixed values of the markup language: elements without an end tag, elements whose inside is no markup, elements
#: that end an open one of their kind, and the containers that shield it
VOID = frozenset(["area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"])
RAW = frozenset(["script", "style"])
ENDS = {"li": {"li"}, "p": {"p"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "dt": {"dt", "dd"},
        "dd": {"dt", "dd"}}
CONTAINERS = frozenset(["ul", "ol", "dl", "table", "select", "div", "section", "article", "nav", "body"])

_TOKEN = re.compile(r"""<!--.*?(?:-->|$)|<(/?)([a-zA-Z][^\s/>]*)((?:[^<>"']|"[^"]*"|'[^']*')*)>|<[!?][^>]*(?:>|$)""", re.S)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_SIMPLE = re.compile(r"([a-zA-Z][\w-]*|\*)?((?:\.[\w-]+|\[[\w-]+(?:=[^\]]*)?\])*)$")
_PART = re.compile(r"\.([\w-]+)|\[([\w-]+)(?:=([^\]]*))?\]")


@dataclass
class Element:
    """An open element: name, attributes (first value of each name wins), classes."""

    tag: str
    attributes: dict[str, str]
    classes: frozenset[str] = field(default_factory=frozenset)


class Selector:
    """``tag.class[attribute=value]`` steps separated by blanks: each step somewhere inside the one before it.

    Every part of a step is optional (``*`` or nothing: any tag).  The empty selector is the record itself.
    """

    def __init__(self, text: str):
        self.steps = []
        for step in text.split():
            m = _SIMPLE.match(step)
            if not m:
                raise ValueError(f"not a selector: {step!r}")
            parts = _PART.findall(m[2])
            self.steps.append(((m[1] or "*").lower(), frozenset(c for c, _, _ in parts if c),
                               [(a.lower(), v.strip("\"'") if f"[{a}=" in step else None) for c, a, v in parts if a]))

    @staticmethod
    def _fits(step, e: Element) -> bool:
        tag, classes, attributes = step
        return (tag in ("*", e.tag) and classes <= e.classes
                and all(a in e.attributes and (v is None or e.attributes[a] == v) for a, v in attributes))

    def step(self, done: int, e: Element) -> tuple[int, bool]:
        """``done``: steps that the ancestors of ``e`` fulfil, outermost first.  Returns the same for what is inside
        ``e``, and whether ``e`` itself is selected."""
        last = len(self.steps) - 1
        if last < 0:
            return 0, False
        selected = done >= last and self._fits(self.steps[last], e)
        return done + (done < last and self._fits(self.steps[done], e)), selected


@dataclass(frozen=True)
class Field:
    """A column of the record: where to look, in order, each ``selector`` (text) or ``selector@attribute``.

    The first source that is found and not empty counts; texts are the element's whole text,
    blanks collapsed and trimmed.  Nothing found: ``default``.
    """

    name: str
    sources: tuple[str, ...]
    default: str | None = None


class _Record:
    """One record being read: per source the value, or the text collected while its element is open; and per
    open element how far each source's selector has come."""

    def __init__(self, depth: int, n: int):
        self.depth, self.values, self.open, self.steps = depth, [None] * n, {}, [[0] * n]


class Scanner:
    """Finds the records of a page; made once per task."""

    def __init__(self, record: str, fields: list[Field]):
        self.record, self.fields, self.sources = Selector(record), fields, []
        for f in fields:
            for s in f.sources:
                where, _, attribute = s.partition("@")
                self.sources.append((Selector(where), attribute.lower() or None))

    def records(self, page: str) -> list[list[str | None]]:
        path, named, steps = [], Counter(), [0]
        done, live = [], []
        at, size = 0, len(page)

        def text(chunk: str) -> None:
            if chunk and live:
                chunk = entities.unescape(chunk)
                for r in live:
                    for _, chunks in r.open.values():
                        chunks.append(chunk)

        def close(depth: int) -> None:
            """End all elements below ``depth`` open ones."""
            for e in path[depth:]:
                named[e.tag] -= 1
            del path[depth:], steps[depth + 1:]
            for r in live:
                del r.steps[max(0, depth - r.depth) + 1:]
                for i in [i for i, (d, _) in r.open.items() if d > depth]:
                    r.values[i] = " ".join("".join(r.open.pop(i)[1]).split())
            while live and live[-1].depth > depth:
                live.pop()

        def take(r: _Record, i: int, attribute: str | None) -> None:
            """The first element that a source selects gives its value."""
            if r.values[i] is not None or i in r.open:
                return
            if attribute is None:
                r.open[i] = (len(path), [])
            elif attribute in path[-1].attributes:
                r.values[i] = path[-1].attributes[attribute].strip()

        def look(r: _Record) -> None:
            now, after = r.steps[-1], []
            for i, (selector, attribute) in enumerate(self.sources):
                reached, selected = selector.step(now[i], path[-1])
                after.append(reached)
                if selected:
                    take(r, i, attribute)
            r.steps.append(after if after != now else now)

        for m in _TOKEN.finditer(page):
            if m.start() < at:
                continue  # inside a script or style
            text(page[at:m.start()])
            at = m.end()
            if m[2] is None:
                continue
            tag = m[2].lower()
            if m[1]:
                for depth in range(len(path) - 1, -1, -1) if named[tag] else ():
                    if path[depth].tag == tag:
                        close(depth)
                        break
                continue
            for depth in range(len(path) - 1, -1, -1) if any(named[t] for t in ENDS.get(tag, ())) else ():
                if path[depth].tag in ENDS[tag]:
                    close(depth)
                    break
                if path[depth].tag in CONTAINERS:
                    break
            attributes = {}
            for name, value in _ATTRIBUTE.findall(m[3]):
                attributes.setdefault(name.lower(), entities.unescape(value.strip("\"'") if value[:1] in "\"'" else value))
            path.append(Element(tag, attributes, frozenset(attributes.get("class", "").split())))
            named[tag] += 1
            for r in live:
                look(r)
            reached, selected = self.record.step(steps[-1], path[-1])
            steps.append(reached)
            if selected:
                r = _Record(len(path), len(self.sources))
                live.append(r)
                done.append(r)
                for i, (selector, attribute) in enumerate(self.sources):
                    if not selector.steps:
                        take(r, i, attribute)
            if tag in VOID or m[3].endswith("/"):
                close(len(path) - 1)
            elif tag in RAW:
                end = re.compile(rf"</{tag}\s*>", re.I).search(page, at)
                at = end.start() if end else size
        text(page[at:])
        close(0)
        return [self._row(r) for r in done]

    def _row(self, r: _Record) -> list[str | None]:
        row, i = [], 0
        for f in self.fields:
            found = [v for v in r.values[i:i + len(f.sources)] if v]
            row.append(found[0] if found else f.default)
            i += len(f.sources)
        return row


def page_records(pages: DataFrame, key: str, html: str, record: str, fields: list[Field]) -> DataFrame:
    """(key, record_no, *fields): every element that ``record`` selects, in page order, numbered from 1.

    Records inside records are records of their own, and their fields also count for the outer
    one.  Null and empty pages have no records.  All field columns are strings.
    """
    names = [f.name for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(record, fields)
        for batch in batches:
            for start in range(0, batch.num_rows, 200):
                part = batch.slice(start, 200)
                row, number, columns = [], [], [[] for _ in names]
                for i, page in enumerate(part.column(1).to_pylist()):
                    for n, values in enumerate(scanner.records(page) if page else []):
                        row.append(i)
                        number.append(n + 1)
                        for c, v in zip(columns, values):
                            c.append(v)
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(row, pa.int64())), pa.array(number, pa.int32()),
                                                  *(pa.array(c, pa.string()) for c in columns)], ["__key", "record_no", *names])

    schema = f"__key {pages.schema[key].dataType.simpleString()}, record_no int, " + ", ".join(f"`{n}` string" for n in names)
    return pages.select(F.col(key).alias("__key"), html).mapInArrow(run, schema).withColumnRenamed("__key", key)
