"""HTML pages as node relations, and the parts of an article they hold.

``html_nodes`` emits one row per element: (page_id, ord, parent, depth, tag, classes, attrs, text). The tree follows a
lenient parser: void elements close at once, an end tag closes the nearest open element of its name, an unmatched end tag
is ignored, paragraphs are not closed by other paragraphs. ``text`` is the text of all descendants without scripts and styles.
Null or empty pages have no nodes.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultlake.functions import text as T
from faultlake.operators import articles as A

VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
SCHEMA = "page_id long, url string, ord int, parent int, depth int, tag string, classes array<string>, attrs map<string,string>, text string"


class _Tree(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.nodes: list[dict] = []
        self.open: list[int] = []

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        values = {k: v or "" for k, v in attrs}
        self.nodes.append({"parent": self.open[-1] if self.open else -1, "depth": len(self.open), "tag": tag, "classes": values.get("class", "").split(), "attrs": values, "parts": []})
        if tag not in VOID:
            self.open.append(len(self.nodes) - 1)

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        for k in range(len(self.open) - 1, -1, -1):
            if self.nodes[self.open[k]]["tag"] == tag:
                del self.open[k:]
                return

    def handle_data(self, data: str) -> None:
        if self.open and self.nodes[self.open[-1]]["tag"] in ("script", "style"):
            return
        for k in self.open:
            self.nodes[k]["parts"].append(data)


def parse(html: str | None) -> list[dict]:
    """Nodes of one page in document order."""
    if not html:
        return []
    tree = _Tree()
    tree.feed(html)
    tree.close()
    return tree.nodes


_STEP = re.compile(r"^([a-zA-Z][\w-]*)?((?:\.[\w-]+)*)$")


def selector(css: str | None) -> list[tuple[str | None, frozenset[str]]] | None:
    """A chain of descendant steps (tag, classes); None for a blank selector, ValueError for one beyond this subset."""
    if not css or not css.strip():
        return None
    steps = []
    for part in css.split():
        found = _STEP.match(part)
        if not found or not part:
            raise ValueError(f"selector not understood: {css}")
        steps.append((found[1].lower() if found[1] else None, frozenset(found[2].split(".")[1:])))
    return steps


def matches(nodes: list[dict], k: int, steps: list[tuple[str | None, frozenset[str]]]) -> bool:
    def fits(n: dict, step: tuple[str | None, frozenset[str]]) -> bool:
        return (step[0] is None or n["tag"] == step[0]) and step[1] <= set(n["classes"])

    if not fits(nodes[k], steps[-1]):
        return False
    at, left = nodes[k]["parent"], len(steps) - 2
    while left >= 0 and at >= 0:
        left -= fits(nodes[at], steps[left])
        at = nodes[at]["parent"]
    return left < 0


def html_nodes(pages: DataFrame) -> DataFrame:
    """One row per element of each page. ``pages``: page_id, url, html."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(i, u, k, n["parent"], n["depth"], n["tag"], n["classes"], n["attrs"], "".join(n["parts"]))
                    for i, u, h in batch.itertuples(index=False) for k, n in enumerate(parse(h))]
            yield pd.DataFrame(rows, columns=["page_id", "url", "ord", "parent", "depth", "tag", "classes", "attrs", "text"])

    return pages.select("page_id", "url", "html").mapInPandas(run, SCHEMA)


def select(pages: DataFrame, css: str) -> DataFrame:
    """(page_id, url, ord, tag, attrs, text) of the elements a selector finds, in document order."""
    steps = selector(css)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for i, u, h in batch.itertuples(index=False):
                nodes = parse(h)
                rows.extend((i, u, k, n["tag"], n["attrs"], "".join(n["parts"])) for k, n in enumerate(nodes) if steps and matches(nodes, k, steps))
            yield pd.DataFrame(rows, columns=["page_id", "url", "ord", "tag", "attrs", "text"])

    return pages.select("page_id", "url", "html").mapInPandas(run, "page_id long, url string, ord int, tag string, attrs map<string,string>, text string")


# Selectors of the site's articles.
SITE = {"article": "a.tpg-post-link", "title": "h1", "content": "div.futurio-content.single-content", "image": "figure img", "category": "span.categories-links a"}


_TEXTS = pa.list_(pa.string())
PARTS = {"title": pa.string(), "date": pa.string(), "paragraphs": _TEXTS, "images": pa.list_(pa.struct([(n, pa.string()) for n in ("data_src", "data_lazy_src", "data_srcset", "srcset", "src")])), "categories": _TEXTS, "tags": _TEXTS,
         "lists": pa.list_(pa.struct([("label", pa.string()), ("items", pa.string())])), "comments": pa.list_(pa.struct([("author", pa.string()), ("texts", _TEXTS), ("date", pa.string())]))}


def article_parts(pages: DataFrame, site: dict[str, str] | None = None) -> DataFrame:
    """One row per page with the raw parts of its article, found by the site's selectors.

    (page_id, url, title, date, paragraphs, images as structs of addresses, categories, tags, lists as structs (label, items),
    comments). The content root falls back to the whole page.
    """
    css = {**SITE, **(site or {})}
    wanted = {k: selector(v) for k, v in css.items() if k != "article"}
    fixed = {k: selector(v) for k, v in {"date": "div.content-date-comments .date-meta", "cat1": "div.cat-links a", "cat2": "span.categories-links a", "tags": "div.tags-links a",
                                         "comment": ".comment-body", "author": "cite.fn", "when": ".comment-meta a", "when2": ".comment-meta"}.items()}

    def one(html: str | None) -> dict:
        nodes = parse(html)
        text = lambda k: "".join(nodes[k]["parts"])
        inside: dict[int, list[int]] = {}
        for k, n in enumerate(nodes):
            inside.setdefault(n["parent"], []).append(k)

        def below(root: int) -> list[int]:
            if root < 0:
                return list(range(len(nodes)))
            out, stack = [], list(reversed(inside.get(root, [])))
            while stack:
                k = stack.pop()
                out.append(k)
                stack.extend(reversed(inside.get(k, [])))
            return out

        by_name: dict[str, list[int]] = {}
        for k, n in enumerate(nodes):
            for name in (n["tag"], *("." + c for c in set(n["classes"]))):
                by_name.setdefault(name, []).append(k)

        def find(steps, among) -> list[int]:
            if not steps:
                return []
            tag, classes = steps[-1]
            some = by_name.get("." + min(classes) if classes else tag, ()) if classes or tag else range(len(nodes))
            inside_ = among if among is whole else set(among)
            return [k for k in some if (among is whole or k in inside_) and matches(nodes, k, steps)]

        whole = below(-1)
        title, date = find(wanted["title"], whole)[:1], find(fixed["date"], whole)[:1]
        root = find(wanted["content"], whole)[:1]
        body = below(root[0]) if root else whole
        lists = []
        for k in body:
            if nodes[k]["tag"] == "ul":
                label = next((text(j) for j in range(k - 1, -1, -1) if nodes[j]["tag"] in ("p", "h1", "h2", "h3", "strong", "b", "span")), "")
                items = " ".join(x for x in (" ".join(nodes[j]["parts"]) for j in below(k) if nodes[j]["tag"] == "li") if x) or text(k)
                lists.append({"label": label, "items": items})
        cats = [text(k) for s in (fixed["cat1"], fixed["cat2"], wanted.get("category")) for k in find(s, whole)]
        comments = []
        for k in find(fixed["comment"], whole):
            own = below(k)
            author, when = find(fixed["author"], own)[:1], (find(fixed["when"], own) or find(fixed["when2"], own))[:1]
            comments.append({"author": text(author[0]) if author else "", "texts": [text(j) for j in own if nodes[j]["tag"] == "p"], "date": text(when[0]) if when else ""})
        images = [{c.replace("-", "_"): nodes[k]["attrs"].get(c, "") for c in ("data-src", "data-lazy-src", "data-srcset", "srcset", "src")} for k in find(wanted["image"], body)]
        return {"title": text(title[0]) if title else "", "date": text(date[0]) if date else "", "paragraphs": [text(k) for k in body if nodes[k]["tag"] == "p"], "images": images,
                "categories": cats, "tags": [text(k) for k in find(fixed["tags"], whole)], "lists": lists, "comments": comments}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [one(h) for h in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.array([r[n] for r in rows], t) for n, t in PARTS.items())], names=["page_id", "url", *PARTS])

    schema = ("page_id long, url string, title string, date string, paragraphs array<string>, images array<struct<data_src:string,data_lazy_src:string,data_srcset:string,srcset:string,src:string>>, "
              "categories array<string>, tags array<string>, lists array<struct<label:string,items:string>>, comments array<struct<author:string,texts:array<string>,date:string>>")
    return pages.where("html is not null and html <> ''").select(F.col("page_id").cast("long"), "url", "html").mapInArrow(run, schema)


def _filled(values):
    return F.filter(F.transform(values, T.collapse_ws), lambda x: x != "")


def parse_articles(pages: DataFrame, site: dict[str, str] | None = None) -> DataFrame:
    """Articles of pages: the field rules run as expressions over ``article_parts``."""
    # columns of their own, so that no paragraph is looked at twice
    parts = article_parts(pages, site).withColumn("_all", _filled(F.col("paragraphs"))).withColumn("_english", F.filter("_all", T.is_english))
    empty = F.array().cast("array<string>")
    codes = F.aggregate(F.transform("lists", lambda x: T.list_fault_codes(T.collapse_ws(x["items"]), T.collapse_ws(x["label"]))), empty, lambda a, b: F.concat(a, b))
    numbers = F.aggregate(F.transform("lists", lambda x: T.list_part_numbers(T.collapse_ws(x["items"]), T.collapse_ws(x["label"]))), empty, lambda a, b: F.concat(a, b))
    candidates = F.filter(F.transform("images", lambda i: T.image_candidate(i["data_src"], i["data_lazy_src"], i["data_srcset"], i["srcset"], i["src"])), lambda u: u.isNotNull())
    made = parts.select(
        "page_id", "url", T.collapse_ws(F.col("title")).alias("title"), T.collapse_ws(F.col("date")).alias("published_date"),
        F.array_join(F.when(F.size("_english") > 0, F.col("_english")).otherwise(F.col("_all")), "\n\n").alias("content"),
        absolute_images(F.col("url"), candidates).alias("images"),
        A.without_word(_filled(F.col("categories")), "crap").alias("categories"), F.array_distinct(_filled(F.col("tags"))).alias("tags"),
        F.array_distinct(codes).alias("fault_codes"), F.array_distinct(numbers).alias("part_numbers"),
        F.transform("comments", lambda c: F.struct(T.collapse_ws(c["author"]).alias("author"), F.array_join(_filled(c["texts"]), "\n\n").alias("text"), T.collapse_ws(c["date"]).alias("date"))).alias("comments"))
    return made.withColumn("images", A.without_inline_images(F.col("images")))


def absolute_images(base, images):
    from pyspark.sql.types import ArrayType, StringType

    @F.pandas_udf(ArrayType(StringType()))
    def resolve(base: pd.Series, images: pd.Series) -> pd.Series:
        from html import unescape
        from urllib.parse import urljoin

        return pd.Series([[urljoin(b or "", unescape(u)) for u in (i if i is not None else ())] for b, i in zip(base, images, strict=True)], dtype=object)

    return resolve(base, images)


def index_links(pages: DataFrame, css: str = SITE["article"]) -> DataFrame:
    """(page_ord, pos, url): article links of the index pages in order. ``pages``: page_id (order), url, html."""
    found = select(pages, css).select(F.col("page_id").alias("page_ord"), F.col("ord").alias("pos"), "url", F.col("attrs")["href"].alias("href"))
    return found.select("page_ord", "pos", T.absolute_url(F.col("url"), F.col("href")).alias("url")).where("url is not null")
