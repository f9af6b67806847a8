"""PDF files as primitive relations through an optional library.

The reader is a Python data source-like map over (document_id, content): it yields pages, words, blocks, lines, links, tables,
bookmarks, labels, drawings and images as rows of one relation each. PyMuPDF is imported only inside the tasks; without it the
call fails with ImportError. It is not installed here: the adapter is tested against a stand-in with the library's calls, not against real files. All operators work on the relations.
"""

from __future__ import annotations

import importlib.util
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame

#: Shares of a page's height that are its header and footer.
HEADER, FOOTER = 0.12, 0.88

SCHEMAS = {
    "document": "document_id string, pages int, title string, author string, subject string, keywords string, creator string, producer string, format string, creation_date string, modification_date string, encryption string",
    "page": "document_id string, page int, width double, height double, text string, header string, footer string",
    "word": "document_id string, page int, ord int, x0 double, y0 double, x1 double, y1 double, text string",
    "block": "document_id string, page int, ord int, x0 double, y0 double, x1 double, y1 double, text string",
    "line": "document_id string, page int, ord int, y0 double, y1 double, text string, all_bold boolean",
    "link": "document_id string, page int, ord int, kind int, lx0 double, ly0 double, lx1 double, ly1 double, target int, dest string",
    "table": "document_id string, page int, ord int, x0 double, y0 double, x1 double, y1 double, rows array<array<string>>",
    "toc": "document_id string, ord int, level int, title string, page int",
    "label": "document_id string, ord int, prefix string, startpage int",
    "drawing": "document_id string, page int, rx0 double, ry0 double, rx1 double, ry1 double",
    "image": "document_id string, page int, ord int, xref int, width int, height int, ext string, content binary",
}


def available() -> bool:
    return importlib.util.find_spec("fitz") is not None


def _pages(pdf) -> Iterator[tuple]:
    for n, page in enumerate(pdf, 1):
        r = page.rect
        yield n, r.width, r.height, *(page.get_text("text", **clip) for clip in ({}, {"clip": (0, 0, r.width, r.height * HEADER)}, {"clip": (0, r.height * FOOTER, r.width, r.height)}))


def _documents(pdf) -> Iterator[tuple]:
    """The file's own metadata; '' is none."""
    known = pdf.metadata or {}
    yield len(pdf), *(known.get(k) or None for k in ("title", "author", "subject", "keywords", "creator", "producer", "format", "creationDate", "modDate", "encryption"))


def _boxes(kind: str) -> Callable:
    def read(pdf) -> Iterator[tuple]:
        for n, page in enumerate(pdf, 1):
            for k, b in enumerate(page.get_text(kind)):
                yield n, k, b[0], b[1], b[2], b[3], b[4]
    return read


def _lines(pdf) -> Iterator[tuple]:
    for n, page in enumerate(pdf, 1):
        k = 0
        for block in page.get_text("dict")["blocks"]:
            for line in block.get("lines", ()):
                spans = line["spans"]
                yield n, k, line["bbox"][1], line["bbox"][3], " ".join(s["text"] for s in spans), bool(spans) and all(s["flags"] & 16 for s in spans)
                k += 1


def _links(pdf) -> Iterator[tuple]:
    for n, page in enumerate(pdf, 1):
        for k, x in enumerate(page.get_links()):
            r = x["from"]
            yield n, k, x["kind"], r.x0, r.y0, r.x1, r.y1, x.get("page", -1) + 1, x.get("nameddest")


def _tables(pdf) -> Iterator[tuple]:
    for n, page in enumerate(pdf, 1):
        for k, t in enumerate(page.find_tables().tables):
            yield n, k, *t.bbox, t.extract()


def _images(pdf) -> Iterator[tuple]:
    for n, page in enumerate(pdf, 1):
        for k, x in enumerate(page.get_images(full=True)):
            found = pdf.extract_image(x[0])
            yield n, k, x[0], found["width"], found["height"], found["ext"], found["image"]


READERS: dict[str, Callable] = {
    "document": _documents, "page": _pages, "word": _boxes("words"), "block": _boxes("blocks"), "line": _lines, "link": _links, "table": _tables, "image": _images,
    "toc": lambda pdf: ((k, level, title, page) for k, (level, title, page) in enumerate(pdf.get_toc())),
    "label": lambda pdf: ((k, x.get("prefix", ""), x.get("startpage")) for k, x in enumerate(pdf.get_page_labels())),
    "drawing": lambda pdf: ((n, d["rect"].x0, d["rect"].y0, d["rect"].x1, d["rect"].y1) for n, page in enumerate(pdf, 1) for d in page.get_drawings()),
}


def relation(files: DataFrame, kind: str) -> DataFrame:
    """One primitive relation of PDF files (document_id, content); a file that can't be read gives no rows."""
    if not available():
        raise ImportError("reading PDF needs the optional PyMuPDF library")
    names = [c.split()[0] for c in SCHEMAS[kind].split(", ")]
    read = READERS[kind]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import fitz

        for batch in batches:
            for document_id, content in batch.itertuples(index=False):
                try:
                    with fitz.open(stream=content, filetype="pdf") as pdf:
                        rows = [(document_id, *r) for r in read(pdf)]
                except (RuntimeError, ValueError):
                    rows = []
                yield pd.DataFrame(rows, columns=names)

    return files.select("document_id", "content").mapInPandas(run, SCHEMAS[kind])
