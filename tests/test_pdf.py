"""The PDF adapter against a stand-in that has the calls of the library; a file is the JSON of what the calls give."""

import json

import pytest

from faultlake.sources import pdf

STAND_IN = '''
import json
from types import SimpleNamespace as Box


def rect(a):
    return Box(x0=a[0], y0=a[1], x1=a[2], y1=a[3], width=a[2] - a[0], height=a[3] - a[1])


class Page:
    def __init__(self, d):
        self.d, self.rect = d, rect((0, 0, 600, 800))

    def get_text(self, kind, clip=None):
        if kind == "text":
            return "\\n".join(t for y, t in self.d["text"] if clip is None or clip[1] <= y <= clip[3])
        if kind == "dict":
            return {"blocks": [{"lines": [{"bbox": b, "spans": [{"text": t, "flags": f} for t, f in spans]} for b, spans in self.d["lines"]]}, {"image": 1}]}
        return self.d[kind]

    def get_links(self):
        return [{"kind": k, "from": rect(r), **more} for k, r, more in self.d["links"]]

    def find_tables(self):
        return Box(tables=[Box(bbox=b, extract=lambda rows=rows: rows) for b, rows in self.d["tables"]])

    def get_images(self, full):
        return [(x, 0, 1, 1) for x in self.d["images"]]

    def get_drawings(self):
        return [{"rect": rect(r)} for r in self.d["drawings"]]


class Pdf(list):
    def __init__(self, d):
        super().__init__(map(Page, d["pages"]))
        self.d, self.metadata = d, d["metadata"]

    def __enter__(self):
        return self

    def __exit__(self, *_):
        return False

    def get_toc(self):
        return self.d["toc"]

    def get_page_labels(self):
        return self.d["labels"]

    def extract_image(self, xref):
        return {"width": xref * 100, "height": 500, "ext": "png", "image": bytes([xref])}


def open(stream, filetype):
    if not stream.startswith(b"{"):
        raise RuntimeError("not a PDF")
    return Pdf(json.loads(stream))
'''
PAGE = {"text": [[10, "DTC Index"], [400, "body"], [790, "EVB-12"]], "words": [[1.0, 2.0, 3.0, 4.0, "P0A0D", 0, 0, 0]], "blocks": [[0.0, 1.0, 9.0, 9.0, "DTC Index\nx", 0, 0]],
        "lines": [[[0, 5.0, 9, 15.0], [["Component ", 16], ["Parts", 20]]], [[0, 20.0, 9, 30.0], [["plain", 0]]], [[0, 40.0, 9, 50.0], []]], "links": [[4, [400, 10, 450, 20], {"page": 4, "nameddest": "d1"}], [2, [0, 0, 1, 1], {}]],
        "tables": [[[0.0, 10.0, 500.0, 90.0], [["DTC", None], ["P0A0D", "pump"]]]], "images": [7], "drawings": [[0, 50, 600, 52]]}
FILE = {"pages": [PAGE, PAGE], "metadata": {"title": "2013 Lyra Manual", "author": "", "creationDate": "D:2013"}, "toc": [[1, "DTC Index", 2]], "labels": [{"prefix": "EVB-", "startpage": 0}, {"startpage": 5}]}
WANT = {
    "document": [("a", 2, "2013 Lyra Manual", None, None, None, None, None, None, "D:2013", None, None)],
    "page": [("a", n, 600.0, 800.0, "DTC Index\nbody\nEVB-12", "DTC Index", "EVB-12") for n in (1, 2)],
    "word": [("a", n, 0, 1.0, 2.0, 3.0, 4.0, "P0A0D") for n in (1, 2)], "block": [("a", n, 0, 0.0, 1.0, 9.0, 9.0, "DTC Index\nx") for n in (1, 2)],
    "line": [("a", n, k, y, y + 10, t, b) for n in (1, 2) for k, (y, t, b) in enumerate([(5.0, "Component  Parts", True), (20.0, "plain", False), (40.0, "", False)])],
    "link": [("a", n, *rest) for n in (1, 2) for rest in ((0, 4, 400.0, 10.0, 450.0, 20.0, 5, "d1"), (1, 2, 0.0, 0.0, 1.0, 1.0, 0, None))],
    "table": [("a", n, 0, 0.0, 10.0, 500.0, 90.0, [["DTC", None], ["P0A0D", "pump"]]) for n in (1, 2)], "toc": [("a", 0, 1, "DTC Index", 2)], "label": [("a", 0, "EVB-", 0), ("a", 1, "", 5)],
    "drawing": [("a", n, 0.0, 50.0, 600.0, 52.0) for n in (1, 2)], "image": [("a", n, 0, 7, 700, 500, "png", bytearray([7])) for n in (1, 2)],
}


@pytest.fixture(scope="module")
def library(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("lib") / "fitz.py"
    path.write_text(STAND_IN)
    spark.sparkContext.addPyFile(str(path))


@pytest.mark.parametrize("kind", sorted(pdf.SCHEMAS))
def test_relations(spark, library, kind):
    files = spark.createDataFrame([("a", bytearray(json.dumps(FILE).encode())), ("broken", bytearray(b"x"))], "document_id string, content binary")
    got = sorted((tuple(r) for r in pdf.relation(files, kind).collect()), key=repr)
    assert got == sorted(WANT[kind], key=repr)
    assert pdf.relation(files.limit(0), kind).count() == 0


def test_without_the_library(spark, monkeypatch):
    monkeypatch.setattr(pdf, "available", lambda: False)
    with pytest.raises(ImportError):
        pdf.relation(spark.createDataFrame([], "document_id string, content binary"), "page")
