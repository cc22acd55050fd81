"""Workbooks through the data source API, feature collections by byte ranges."""

import json
import random
import zipfile

import pytest
from pyspark.sql import functions as F

from sparkpanel.sources import files, formats


def test_workbooks_round_trip_by_header_name(spark, tmp_path):
    rows = [(i, f"name <{i}> & \"x\" é", None if i % 4 == 0 else i / 8, "x\ny" if i % 3 else None) for i in range(200)]
    df = spark.createDataFrame(rows, "code long, label string, share double, note string").repartition(3, "code")
    out = str(tmp_path / "books")
    assert formats.write_code_sheets(df, out).agg(F.sum("n_rows")).first()[0] == 200
    back = files.read_source(spark, "code_sheet", out, schema="label string, code long, note string, share double")
    assert sorted((r.code, r.label, r.share, r.note) for r in back.collect()) == rows
    texts = spark.read.format("code_sheet").load(out)
    assert texts.columns == ["code", "label", "share", "note"] and texts.where("code = '199'").first().share == "24.875"
    with pytest.raises(Exception, match="no column"):
        spark.read.format("code_sheet").schema("other string").load(out).collect()


def test_shared_strings_gaps_and_named_sheets(spark, tmp_path):
    main, rel = formats._MAIN[1:-1], formats._REL[1:-1]
    with zipfile.ZipFile(tmp_path / "a.xlsx", "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook xmlns="{main}" xmlns:r="{rel}"><sheets><sheet name="first" r:id="a"/><sheet name="codes" r:id="b"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<R><Relationship Id="a" Target="worksheets/s1.xml"/><Relationship Id="b" Target="/xl/worksheets/s2.xml"/></R>')
        z.writestr("xl/sharedStrings.xml", f'<sst xmlns="{main}"><si><t>Code</t></si><si><r><t>Na</t></r><r><t>me</t></r></si><si><t>Seoul</t></si></sst>')
        z.writestr("xl/worksheets/s1.xml", f'<worksheet xmlns="{main}"><sheetData/></worksheet>')
        z.writestr("xl/worksheets/s2.xml", f'<worksheet xmlns="{main}"><sheetData><row><c r="A1" t="s"><v>0</v></c><c r="C1" t="s"><v>1</v></c></row><row/>'
                   '<row><c r="A3"><v>11010.0</v></c><c r="C3" t="s"><v>2</v></c></row><row><c r="A4" t="str"><v>n/a</v></c></row></sheetData></worksheet>')
    formats.register_formats(spark)
    df = spark.read.format("code_sheet").option("sheet", "codes").schema("code int, name string").load(str(tmp_path / "a.xlsx"))
    assert sorted(map(tuple, df.collect()), key=str) == [(11010, "Seoul"), (None, None)]
    with pytest.raises(Exception, match="no sheet"):
        spark.read.format("code_sheet").option("sheet", "x").load(str(tmp_path / "a.xlsx"))
    assert spark.read.format("code_sheet").schema("code int").load(str(tmp_path)).where("false").count() == 0


def collection(rng, n):
    odd = ['"', "\\", "\\\"", "{", "}", "[", "]", "é🙂", "\\u0041", "a"]

    def value(depth):
        kind = rng.randrange(4) if depth else 3
        if kind == 0:
            return {"".join(rng.choices(odd, k=2)): value(depth - 1) for _ in range(rng.randrange(3))}
        if kind == 1:
            return [value(depth - 1) for _ in range(rng.randrange(3))]
        return "".join(rng.choices(odd, k=rng.randrange(6)))

    features = [{"type": "Feature", "properties": {"name": value(2)}, "geometry": value(3)} for _ in range(n)]
    return {"type": "FeatureCollection", "others": [{"no": 1}], "features": features, "crs": {"features": [{"no": 2}]}, "tail \"features": [{"no": 3}]}


@pytest.mark.parametrize("seed,size", [(1, 1), (2, 3), (3, 7), (4, 64), (5, 1 << 20)])
def test_ranges_of_any_size_give_the_same_features(tmp_path, seed, size):
    """The scan itself, without a session: effects composed over ranges of a few bytes."""
    import pandas as pd

    rng = random.Random(seed)
    doc = collection(rng, 6)
    raw = json.dumps(doc, ensure_ascii=seed % 2 == 0, indent=seed % 3 or None).encode()
    path = tmp_path / "c.json"
    path.write_bytes(raw)
    ranges = [(str(path), a, min(len(raw), a + size)) for a in range(0, len(raw), size)]
    effects = pd.concat(formats._effects([pd.DataFrame(ranges, columns=["path", "start", "end"])]))
    known, text, depth = [], formats.OUTSIDE, 0
    for (p, a, b), states, depths in zip(ranges, effects["states"], effects["depths"]):
        known.append((p, a, b, text, depth))
        text, depth = states[text], depth + depths[text]
    assert (text, depth) == (formats.OUTSIDE, 0)
    rows = pd.concat(formats._features([pd.DataFrame(known, columns=["path", "start", "end", "text", "depth"])])).sort_values("place")
    arrays = [(p, v) for p, k, v in zip(rows["place"], rows["kind"], rows["value"]) if k == "array"]
    got = [json.loads(v) for p, k, v in zip(rows["place"], rows["kind"], rows["value"])
           if k == "object" and [n for q, n in arrays if q < p][-1] == "features"]
    assert got == doc["features"]


def test_feature_collections_of_a_folder(spark, tmp_path):
    rng = random.Random(9)
    docs = {f"{i}.json": collection(rng, i * 3) for i in range(3)}
    for name, doc in docs.items():
        (tmp_path / name).write_text(json.dumps(doc))
    (tmp_path / "empty.json").write_text("")
    (tmp_path / "list.json").write_text('[{"features": [{"a": 1}]}]')
    got = files.read_source(spark, "feature_collection", str(tmp_path), range_bytes=100).collect()
    for name, doc in docs.items():
        assert [json.loads(r.feature) for r in sorted(got, key=lambda r: r.place) if r.path.endswith(f"/{name}")] == doc["features"]
    assert {r.path.rsplit("/", 1)[1] for r in got} == {"1.json", "2.json"}
    (tmp_path / "cut.json").write_text('{"features": [{"a": 1}, {"b": ')
    with pytest.raises(Exception, match="does not end"):
        formats.feature_collection(spark, str(tmp_path / "cut.json"), range_bytes=5)
