"""Main content of web pages without their frame (problem 6).

A page is streamed through the standard library's HTML parser, line by line: each line has the signs of its text outside
links and its number of tags. Pages stored as text have one element a line and no tags left, so the tags a line implies
are taken (``form_of``): entries between separators, titles of other pages and teasers cut off by an ellipsis are links; sentences,
list entries and captions are text of one element. The line's *ratio* is log(1 + text / tags); text that recurs over a site's
pages is the site's, not the page's, and has ratio 0. A Gaussian smooths the ratios over the lines, and a two-cluster
threshold of the smoothed ratios of all pages (``Cut``) says which places are dense:

* a line with text of its own is content if it is dense itself or lies in a dense region;
* a recurring line has no text of its own, so the ratio round it decides, smoothed from the lines before and from those after it and averaged over
  all its pages: a sentence must touch a dense side, a title must lie in a dense place and open a region (the ratio rises after it by ``RISE``).
  Notices, menus and sharing lines lie in sparse places, and after labels of advertising inside the text nothing rises.

Counts cover all pages, a page delivered again once. A line recurs if its template (digits and months removed) stands on at least ``OFTEN``
pages and a share ``SITE_SHARE`` of the pages of one site, or ``CORPUS_SHARE`` of all pages. Each page is parsed once and staged as its lines' numbers,
kinds, ratios and template hashes; what follows is array work on these. Up to ``MAX_SHARED`` hashes and verdicts are sent to the tasks; more are joined
to the pages by template hash, with the same result. Null or empty content gives no lines, and blank lines are never content.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faultlake.session import checked_broadcast, stage

OFTEN, SITE_SHARE, CORPUS_SHARE = 4, 0.005, 0.0005
#: So many recurring templates at most are sent to every task.
MAX_SHARED = 200_000
#: Width of the Gaussian in lines, and how much the ratio rises after a title that opens a region.
SIGMA, RISE = 1.5, 0.5
REACH = int(3 * SIGMA)
#: A ratio of 25.5 is a line of 10^11 signs; cells of the histogram that the threshold is taken from are 0.1 wide.
CELLS, WIDTH = 256, 0.1

# What opens a caption, and names of months.
CAPTION = re.compile(r"(?:Fig(?:ure|\.)?|Abb(?:ildung|\.)?|Pic(?:ture)?|Photo|Foto|Bild|Image|Imagen)\s*\d+\s*[:.–-]", re.I)
MONTHS = re.compile(r"\b(?:January|February|March|April|May|June|July|August|September|October|November|December|Jan|Feb|Mar|Apr|Jun|Jul|Aug|Sep|Oct|Nov|Dec)\b")
CODE = re.compile(r"[-•*–·\d.)\s]*(?:[PBCU][0-9A-F]{4}\b|[A-Z]\d{4,9}-[A-Z0-9]+\b)")
COUNTED = re.compile(r"\(\d+\)$")
MENU = re.compile(r"\S {2,}\S.*\S {2,}\S")

SENTENCE, ENTRY, CAPTIONED, CHAIN, TEASER, HEADED = range(6)
LINKS = (CHAIN, TEASER, HEADED)
#: A non-blank line: its number, form, ratio and template hash (0: not looked at for recurrence).
LINE = np.dtype([("no", np.int32), ("form", np.int8), ("ratio", np.float32), ("mark", np.int64)])


class _Lines(HTMLParser):
    """Text, signs outside links and tags by line; used only where a page still has markup."""

    def __init__(self, n: int) -> None:
        super().__init__(convert_charrefs=True)
        self.text, self.signs, self.tags, self.skip, self.link = [""] * n, [0] * n, [0] * n, 0, 0

    def handle_starttag(self, tag: str, attrs: list) -> None:
        self.tags[self.getpos()[0] - 1] += 1
        self.skip += tag in ("script", "style")
        self.link += tag == "a"

    def handle_endtag(self, tag: str) -> None:
        self.tags[self.getpos()[0] - 1] += 1
        if tag in ("script", "style") and self.skip:
            self.skip -= 1
        if tag == "a" and self.link:
            self.link -= 1

    def handle_data(self, data: str) -> None:
        if not self.skip:
            at = self.getpos()[0] - 1
            for k, part in enumerate(data.split("\n")):
                if at + k < len(self.text):
                    self.text[at + k] += part
                    self.signs[at + k] += 0 if self.link else len(part.strip())


def form_of(line: str) -> int:
    """The form of a non-empty line."""
    if CODE.match(line):
        return ENTRY
    if CAPTION.match(line):
        return CAPTIONED
    sentence = line.endswith((".", "?", "!", '"', "»", "”"))
    if "©" in line or " » " in line or " > " in line or line.count(" | ") >= 2 or line.count(" · ") >= 2 or line.count(" / ") >= 2:
        return SENTENCE if sentence and len(line) > 200 else CHAIN
    if not sentence and MENU.search(line):
        return CHAIN
    if "…" in line[-40:] and not line.endswith("…") or COUNTED.search(line):
        return TEASER
    return SENTENCE if sentence else HEADED


def template_of(line: str) -> str:
    return MONTHS.sub("M", re.sub(r"\d+", "0", line))


class _Known(dict):
    """line -> (form, signs of text outside links, template hash), kept for the lines of a task."""

    def __missing__(self, line: str) -> tuple[int, int, int]:
        if len(self) > 200_000:
            self.clear()
        form = form_of(line)
        mark = xxhash.xxh3_64_intdigest(template_of(line)) - (1 << 63) if form in (SENTENCE, HEADED) else 0
        found = self[line] = (form, 0 if form in LINKS else len(line), mark)
        return found


def lines_of(content: str, known: _Known) -> tuple[list[str], list[tuple[int, int, float, int]]]:
    """The stripped text of every line, and (number, form, text per tag, mark) of those that are not blank."""
    raw = content.split("\n")
    if "<" in content and re.search(r"</?[a-zA-Z]", content):
        parser = _Lines(len(raw))
        try:
            parser.feed(content)
            parser.close()
            text = [x.strip() for x in parser.text]
            # Real tags say what is a link; the form tells sentences from titles.
            return text, [(i, known[x][0], parser.signs[i - 1] / max(1, parser.tags[i - 1]), known[x][2]) for i, x in enumerate(text, 1) if x]
        except (AssertionError, ValueError):
            pass
    text = [x.strip() for x in raw]
    return text, [(i, (k := known[x])[0], float(k[1]), k[2]) for i, x in enumerate(text, 1) if x]


def _site(articles: DataFrame) -> Column:
    """Hash of the host an article comes from; without a source all are one site."""
    source = F.col("source") if "source" in articles.columns else F.lit("")
    return F.xxhash64(F.lower(F.regexp_extract(F.coalesce(source, F.lit("")), r"^(?:[A-Za-z]+:)?(?://)?([^/?#]+)", 1)))


def parsed(articles: DataFrame, keep_text: bool = False) -> DataFrame:
    """(article_id, site, lines) of every page with text, staged, each page once; with ``keep_text`` the lines' text as well."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Known()
        for batch in batches:
            rows, texts = [], []
            for content in batch.column(2).to_pylist():
                text, lines = lines_of(content, known)
                found = np.array(lines, dtype=LINE)
                found["ratio"] = np.log1p(found["ratio"])
                rows.append(found.tobytes())
                texts.append(text)
            columns = [batch.column(0), batch.column(1), pa.array(rows, pa.binary())]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(texts, pa.list_(pa.string()))] if keep_text else columns, names=names)

    names = ["article_id", "site", "lines", "text"][: 3 + keep_text]
    schema = "article_id long, site long, lines binary" + (", text array<string>" if keep_text else "")
    pages = articles.where("article_id is not null and content is not null and content <> ''").select(F.col("article_id").cast("long"), _site(articles).alias("site"), "content")
    return stage(pages.mapInArrow(run, schema).dropDuplicates(["article_id"]))


def _decoded(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All lines of a batch of pages, and the number of lines of each page."""
    rows = column.to_pylist()
    return np.frombuffer(b"".join(rows), dtype=LINE), np.array([len(x) // LINE.itemsize for x in rows], dtype=np.int64)


def page_marks(pages: DataFrame) -> DataFrame:
    """(article_id, site, mark): the templates of each page, each once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lines, sizes = _decoded(batch.column(2))
            found = np.stack([np.repeat(np.arange(len(sizes)), sizes), lines["mark"]])[:, lines["mark"] != 0]
            at, marks = np.unique(found, axis=1) if found.size else found
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at)), batch.column(1).take(pa.array(at)), pa.array(marks)], names=["article_id", "site", "mark"])

    return pages.select("article_id", "site", "lines").mapInArrow(run, "article_id long, site long, mark long")


def recurring(pages: DataFrame) -> DataFrame:
    """(mark): templates that recur on the pages of a site, or of all sites; staged."""
    sites = pages.groupBy("site").agg(F.count("*").alias("pages"))
    total = pages.count()
    by_site = page_marks(pages).groupBy("mark", "site").agg(F.count("*").alias("n"))
    of_site = by_site.join(checked_broadcast(sites, MAX_SHARED), "site").withColumn("here", F.col("n") >= F.greatest(F.lit(OFTEN), F.col("pages") * SITE_SHARE))
    counted = of_site.groupBy("mark").agg(F.sum("n").alias("n"), F.max("here").alias("here"))
    return stage(counted.where(F.col("here") | (F.col("n") >= max(OFTEN, CORPUS_SHARE * total))).select("mark"))


#: Marks and verdicts for a batch of pages: sorted marks and what is said of each.
Known = tuple[np.ndarray, np.ndarray]


def _look_up(marks: np.ndarray, known: Known) -> np.ndarray:
    """What ``known`` says of each mark, -1 where nothing."""
    keys, said = known
    if not len(keys):
        return np.full(len(marks), -1)
    place = np.minimum(np.searchsorted(keys, marks), len(keys) - 1)
    return np.where(keys[place] == marks, said[place], -1)


def smoothed(ratio: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Gaussian-smoothed ratio at each line, and the same from the lines before it and after it alone; pages do not touch."""
    place = np.arange(len(ratio)) + np.repeat(REACH * (np.arange(len(sizes)) + 1), sizes)
    padded = np.zeros(len(ratio) + REACH * (len(sizes) + 1))
    padded[place] = ratio
    one = np.exp(-0.5 * (np.arange(1, REACH + 1) / SIGMA) ** 2)
    both = np.concatenate([one[::-1], [1.0], one])
    after = np.convolve(padded, np.concatenate([one[::-1], np.zeros(REACH + 1)]) / one.sum(), mode="same")[place]
    before = np.convolve(padded, np.concatenate([np.zeros(REACH + 1), one]) / one.sum(), mode="same")[place]
    return np.convolve(padded, both / both.sum(), mode="same")[place], before, after


def two_clusters(counts: np.ndarray) -> float:
    """The threshold between the two clusters of a histogram of smoothed ratios."""
    x = (np.arange(len(counts)) + 0.5) * WIDTH
    filled = np.flatnonzero(counts)
    if not len(filled):
        return 0.0
    low, high = x[filled[0]], x[filled[-1]]
    for _ in range(100):
        above = x > (low + high) / 2
        if not counts[above].sum() or not counts[~above].sum():
            break
        new = (x * counts)[~above].sum() / counts[~above].sum(), (x * counts)[above].sum() / counts[above].sum()
        if abs(new[0] - low) + abs(new[1] - high) < 1e-9:
            break
        low, high = new
    return float(low + high) / 2


def _each_batch(pages: DataFrame, said: DataFrame, run: Callable[[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray], pa.RecordBatch | None], schema: str, text: bool = False) -> DataFrame:
    """``run`` over all batches of pages (lines, lines of each page, what ``said`` (mark, verdict) says of each line)."""
    if said.count() <= MAX_SHARED:
        rows = sorted((r["mark"], r["verdict"]) for r in said.toLocalIterator())
        shared = pages.sparkSession.sparkContext.broadcast((np.array([m for m, _ in rows], np.int64), np.array([v for _, v in rows], np.int64)))

        def plain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                lines, sizes = _decoded(batch.column("lines"))
                if (found := run(batch, lines, sizes, _look_up(lines["mark"], shared.value))) is not None:
                    yield found

        return pages.mapInArrow(plain, schema)
    own = page_marks(pages).join(said, "mark").groupBy("article_id").agg(F.collect_list(F.struct("mark", "verdict")).alias("own"))
    joined = pages.join(own, "article_id", "left").select(*pages.columns, F.col("own.mark").alias("marks"), F.col("own.verdict").alias("verdicts"))

    def with_own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lines, sizes = _decoded(batch.column("lines"))
            out, begin = np.full(len(lines), -1), 0
            for n, marks, verdicts in zip(sizes.tolist(), batch.column("marks").to_pylist(), batch.column("verdicts").to_pylist(), strict=True):
                own = dict(zip(marks or (), verdicts or (), strict=True))
                out[begin:begin + n] = [own.get(m, -1) for m in lines["mark"][begin:begin + n].tolist()]
                begin += n
            if (found := run(batch, lines, sizes, out)) is not None:
                yield found

    return joined.mapInArrow(with_own, schema)


def _own_ratio(lines: np.ndarray, said: np.ndarray) -> np.ndarray:
    """Ratios with recurring lines as text of the site."""
    return np.where(said >= 0, 0.0, lines["ratio"])


def verdicts(pages: DataFrame) -> tuple[DataFrame, float]:
    """(mark, verdict) 1 (body) or 0 (frame) for every recurring template, staged, and the threshold of dense places."""
    often = recurring(pages)

    def run(batch: pa.RecordBatch, lines: np.ndarray, sizes: np.ndarray, said: np.ndarray) -> pa.RecordBatch | None:
        if not len(lines):
            return None
        here, before, after = smoothed(_own_ratio(lines, said), sizes)
        cells = [np.bincount(np.minimum(x / WIDTH, CELLS - 1).astype(int), minlength=CELLS) for x in (here, np.maximum(before, after))]
        at = np.flatnonzero(said >= 0)
        marks, place = np.unique(lines["mark"][at], return_inverse=True)
        of = lambda x: np.bincount(place, weights=x[at], minlength=len(marks))
        title = np.zeros(len(marks))
        np.maximum.at(title, place, lines["form"][at] == HEADED)
        rest = np.zeros(2 * CELLS)
        columns = [np.repeat(np.arange(3, dtype=np.int32), [len(marks), CELLS, CELLS]), np.concatenate([marks, np.arange(CELLS), np.arange(CELLS)]), np.concatenate([np.bincount(place, minlength=len(marks)), *cells]),
                   np.concatenate([of(before), rest]), np.concatenate([of(after), rest]), np.concatenate([title, rest]).astype(np.int32)]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["what", "mark", "n", "before", "after", "title"])

    sums = stage(_each_batch(pages, often.withColumn("verdict", F.lit(1)), run, "what int, mark long, n long, before double, after double, title int")
                 .groupBy("what", "mark").agg(F.sum("n").alias("n"), F.sum("before").alias("before"), F.sum("after").alias("after"), F.max("title").alias("title")))
    counts = np.zeros((2, CELLS))
    for r in sums.where("what > 0").collect():  # twice CELLS rows
        counts[r["what"] - 1, r["mark"]] = r["n"]
    cut, edge = two_clusters(counts[0]), two_clusters(counts[1])
    title = ((F.col("before") + F.col("after")) / 2 > cut * F.col("n")) & (F.col("after") - F.col("before") > RISE * F.col("n"))
    body = F.when(F.col("title") == 1, title).otherwise(F.greatest("before", "after") > edge * F.col("n"))
    return stage(sums.where("what = 0").select("mark", body.cast("int").alias("verdict"))), cut


def own_lines(lines: np.ndarray, sizes: np.ndarray, said: np.ndarray, cut: float) -> np.ndarray:
    """Which lines are the pages' own, by the smoothed ratio."""
    ratio = _own_ratio(lines, said)
    here, before, after = smoothed(ratio, sizes)
    return np.where(said >= 0, (said == 1) & (np.maximum(before, after) > cut / 4), (ratio > 0) & (np.maximum(ratio, here) > cut))


def main_lines(articles: DataFrame) -> DataFrame:
    """(article_id, line_no) of the lines of content that are the article's own."""
    pages = parsed(articles)
    said, cut = verdicts(pages)

    def run(batch: pa.RecordBatch, lines: np.ndarray, sizes: np.ndarray, found: np.ndarray) -> pa.RecordBatch:
        own = np.flatnonzero(own_lines(lines, sizes, found, cut)) if len(lines) else np.zeros(0, int)
        at = np.repeat(np.arange(len(sizes)), sizes)[own]
        return pa.RecordBatch.from_arrays([batch.column("article_id").take(pa.array(at)), pa.array(lines["no"][own])], names=["article_id", "line_no"])

    return _each_batch(pages, said, run, "article_id long, line_no int")


def main_text(articles: DataFrame) -> DataFrame:
    """(article_id, body, n_lines, n_kept): the text of each page's own lines, one row per page."""
    pages = parsed(articles, keep_text=True)
    said, cut = verdicts(pages.drop("text"))

    def run(batch: pa.RecordBatch, lines: np.ndarray, sizes: np.ndarray, found: np.ndarray) -> pa.RecordBatch:
        own = own_lines(lines, sizes, found, cut) if len(lines) else np.zeros(0, bool)
        body, kept, begin = [], [], 0
        for n, text in zip(sizes.tolist(), batch.column("text").to_pylist(), strict=True):
            numbers = lines["no"][begin:begin + n][own[begin:begin + n]].tolist()
            body.append("\n".join(text[i - 1] for i in numbers))
            kept.append(len(numbers))
            begin += n
        return pa.RecordBatch.from_arrays([batch.column("article_id"), pa.array(body, pa.string()), pa.array(sizes.astype(np.int32)), pa.array(kept, pa.int32())], names=["article_id", "body", "n_lines", "n_kept"])

    return _each_batch(pages, said, run, "article_id long, body string, n_lines int, n_kept int")
