"""JSON of several shapes, against plain readers, without a Python worker."""

import json

from quiremill.sources import metadata as M


def label_of(value):
    if isinstance(value, str) or value is None:
        return value or ""
    values = value if isinstance(value, list) else [value["@value"]] if "@value" in value else list(value.values()) if isinstance(value, dict) else []
    return next((t for t in map(label_of, values) if t), "")


def plan_of(df):
    return df._jdf.queryExecution().toString()


def test_manifests_of_both_versions(spark):
    two = {"label": "M", "sequences": [{"canvases": [
        {"@id": "c1", "label": "p. \"1\"", "width": 10, "height": 20, "images": [{"resource": {"@id": "http://x/i.jpg", "service": {"@id": "http://x/s/"}}}]},
        {"@id": "c2", "label": [{"@value": "zwei", "@language": "de"}, {"@value": "two", "@language": "en"}], "width": 1, "height": 2, "images": [{"resource": {"@id": "http://x/j.jpg"}}]},
        {"@id": "c3", "images": []},
        {"@id": "c4", "label": "", "images": [{"resource": {"service": [{"@id": "http://x/t"}]}}]},
    ]}]}
    three = {"items": [
        {"id": "d1", "label": {"none": ["", "iü"]}, "width": 3, "height": 4, "items": [{"items": []}, {"items": [{"body": {"id": "http://y/a.jpg", "service": [{"id": "http://y/s//"}]}}]}]},
        {"id": "d2", "label": {"en": ["x"]}, "items": [{"items": [{"body": [{"id": "http://y/b.jpg", "service": {"@id": "http://y/q"}}]}]}]},
        {"id": "d3", "label": {}, "items": []},
        {"id": "d4", "items": [{"items": [{"body": {"id": "http://y/c.jpg"}}]}]},
    ]}
    rows = [("two", json.dumps(two)), ("three", json.dumps(three)), ("bad", "{no"), ("null", None), ("empty", "{}")]
    df = M.iiif_pages(spark.createDataFrame(rows, "job string, json string"))
    got = {(r.job, r.page_num): tuple(r)[2:] for r in df.collect()}
    assert got == {
        ("two", 1): ('p. "1"', "c1", 10, 20, "http://x/s/full/full/0/default.jpg", "page_0001.jpg"), ("two", 2): ("zwei", "c2", 1, 2, "http://x/j.jpg", "page_0002.jpg"),
        ("two", 3): ("", "c3", None, None, None, "page_0003.jpg"), ("two", 4): ("", "c4", None, None, "http://x/t/full/full/0/default.jpg", "page_0004.jpg"),
        ("three", 1): ("iü", "d1", 3, 4, "http://y/s/full/max/0/default.jpg", "page_0001.jpg"), ("three", 2): ("x", "d2", None, None, "http://y/q/full/max/0/default.jpg", "page_0002.jpg"),
        ("three", 3): ("", "d3", None, None, None, "page_0003.jpg"), ("three", 4): ("", "d4", None, None, "http://y/c.jpg", "page_0004.jpg"),
    }
    for c in two["sequences"][0]["canvases"] + three["items"]:
        job, n = next(k for k, v in got.items() if v[1] == (c.get("id") or c.get("@id")))
        assert got[job, n][0] == label_of(c.get("label"))
    assert "InPandas" not in plan_of(df) and "Arrow" not in plan_of(df)


def test_canonical_shapes_keep_their_order(spark):
    entries = [{"ref": "1.1.10", "devanagari": "", "text": "ten", "id": 7}, {"sutra": "b", "dhatu": "root", "text": "t"}, {"text": "no key"}, {"ref": None, "code": "c", "id": "c"}]
    shapes = {
        "list": entries, "sutras": {"sutras": entries, "entries": [{"ref": "other"}]}, "entries": {"sutras": [], "entries": entries, "x": 1},
        "map": {"1.1.10": {"text": "ten", "id": 7}, "1.1.2": {"ref": "two", "devanagari": "d"}, "1.1.1": "just text", "0": {}},
    }
    rows = [(k, json.dumps(v, indent=1)) for k, v in shapes.items()] + [("none", None), ("empty", "[]")]
    df = M.canonical_entries(spark.createDataFrame(rows, "job string, json string"))
    got = {}
    for r in df.orderBy("job", "ord").collect():
        got.setdefault(r.job, []).append((r.ord, r.ref, r["keys"], r.text))
        assert isinstance(json.loads(r.payload), dict)
    listed = [(0, "1.1.10", ["1.1.10", "7"], "ten"), (1, "b", ["b", "root"], "root"), (2, "2", [], "no key"), (3, "c", ["c"], "")]
    assert got == {"list": listed, "sutras": listed, "entries": listed, "map": [(0, "1.1.10", ["1.1.10", "7"], "ten"), (1, "two", ["two"], "d"), (2, "1.1.1", ["1.1.1"], "just text"), (3, "0", ["0"], "")]}
    assert "InPandas" not in plan_of(df)
    import pytest

    with pytest.raises(Exception, match="no JSON in the canonical text of bad"):
        M.canonical_entries(spark.createDataFrame([("bad", "{no")], "job string, json string")).collect()
