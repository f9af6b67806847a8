"""Schemas that drift between files (problem 2).

JSON payloads are loaded as path-value maps with their raw JSON types, one row a file; path and type statistics by feed
(first file, last file, count, types) give the changes of every feed, and the maps are then projected to one
table with steady, typed columns, with a report of every value that the column's type could not take.

Definitions: a field is a dotted path to a value that is no object; arrays are values. A key is taken as it
stands, so a key that itself holds a dot reads like a nested path. Null values count for presence, not for
the type. Payloads that are null, empty, no valid JSON or no JSON object are left out everywhere. Files of
a feed are ordered by ``written_at`` (then file_id); a file delivered again counts once. Files without
feed_id, file_id or written_at have no place in the order and are left out. Empty input gives empty output.

Values and their forms are compared as they are (by hash, counted before they are joined), and only those of paths that end or
begin beside another; everything else is settled by one aggregate over paths and types.
"""

from __future__ import annotations

import json
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from faultlake.session import checked_broadcast, global_ordinal, stage

#: Overlaps of values or forms from which two kinds of values are alike, see ``_pair_up``.
ALIKE, CERTAIN, COARSE = 0.5, 0.9, 0.35
#: Files of one feed are compared in blocks of so many, so a huge feed is never one task.
BLOCK = 4096
#: Up to so many renamed paths or paths looked at are sent to the tasks; more are joined by shuffle.
MAX_SENT = 100_000

#: JSON types by number; 0 is null.
TYPES = ("", "array", "boolean", "number", "string")
ITEM = pa.struct([("path", pa.string()), ("jtype", pa.int8()), ("value", pa.string())])
FILE_SCHEMA = "feed_id long, file_id long, written_at timestamp_ntz, items array<struct<path: string, jtype: tinyint, value: string>>"


def _no_constant(text: str):
    raise ValueError(text)


def parse_object(payload: str | None) -> dict | None:
    """The JSON object in ``payload``, or None where there is none. NaN and Infinity are no JSON."""
    if not payload:
        return None
    try:
        found = json.loads(payload, parse_constant=_no_constant, parse_int=_Raw, parse_float=_Raw)
    except (ValueError, RecursionError):
        return None
    return found if isinstance(found, dict) else None


class _Raw(str):
    """A number as written."""


def as_text(value) -> str:
    """JSON text of a value with numbers as written."""
    if isinstance(value, _Raw):
        return str(value)
    if isinstance(value, list):
        return "[" + ", ".join(map(as_text, value)) + "]"
    if isinstance(value, dict):
        return "{" + ", ".join(f"{json.dumps(k, ensure_ascii=False)}: {as_text(v)}" for k, v in value.items()) + "}"
    return json.dumps(value, ensure_ascii=False)


def flatten(found: dict) -> dict[str, tuple[int, str | None]]:
    """path -> (number of the JSON type, text of the value); objects are walked with a stack, so depth is no limit."""
    out: dict[str, tuple[int, str | None]] = {}
    stack: list[tuple[str, dict]] = [("", found)]
    while stack:
        prefix, node = stack.pop()
        for key, value in node.items():
            path = f"{prefix}.{key}" if prefix else key
            if isinstance(value, dict):
                stack.append((path, value))
            elif value is None:
                out[path] = (0, None)
            elif isinstance(value, bool):
                out[path] = (2, "true" if value else "false")
            elif isinstance(value, _Raw):
                out[path] = (3, str(value))
            elif isinstance(value, str):
                out[path] = (4, value)
            else:
                out[path] = (1, as_text(value))
    return out


_HEX = re.compile(r"[0-9a-f]{8,}")


def shape(jtype: int, value: str) -> str:
    """The form of a value: runs of capitals, small letters and digits become one sign each, repeated words one."""
    if jtype == 3:
        try:
            x = float(value)
        except (ValueError, OverflowError):
            return "number"
        if not math.isfinite(x):
            return "number"
        return f"{'i' if x == int(x) else 'd'}{len(str(abs(int(x))))}"
    if jtype == 2:
        return "boolean"
    if _HEX.fullmatch(value) and re.search(r"\d", value):
        return f"hex{len(value)}"
    text = re.sub(r"\d+", "9", value)
    text = re.sub(r"[^\W\d_]+", lambda m: "A" if m[0].isupper() else "Aa" if m[0][0].isupper() else "a", text)
    return re.sub(r"(\b\w+)( \1)+", r"\1+", text)


_CASED, _WORDS, _NUMBERS = re.compile(r"9?(Aa|A|a)+9?"), re.compile(r"w([ -](w|9))+"), re.compile(r"9([ -]9)*[ -]w([ -](w|9))*")


def coarse(jtype: int, value: str, form: str) -> str:
    """A form without the number of words or digits."""
    if jtype == 3:
        digits = re.search(r"[0-9]+", value)
        return form[:1] + ("long" if digits and len(digits[0]) > 3 else "short")
    return form if form.startswith("hex") else _NUMBERS.sub("w", _WORDS.sub("w", _CASED.sub("w", form.replace("+", ""))))


def path_maps(files: DataFrame) -> DataFrame:
    """One row per readable file as delivered: (feed_id, file_id, written_at, items: path, number of the JSON type, text of the value), staged."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, ends, paths, types, values = [], [0], [], [], []
            for i, text in enumerate(batch.column(3).to_pylist()):
                if (found := parse_object(text)) is not None:
                    flat = flatten(found)
                    at.append(i)
                    paths += flat
                    for jtype, value in flat.values():
                        types.append(jtype)
                        values.append(value)
                    ends.append(len(paths))
            items = pa.StructArray.from_arrays([pa.array(paths, pa.string()), pa.array(types, pa.int8()), pa.array(values, pa.string())], fields=list(ITEM))
            rows = batch.take(pa.array(at, pa.int32()))
            yield pa.RecordBatch.from_arrays([*(rows.column(i) for i in range(3)), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), items)], names=["feed_id", "file_id", "written_at", "items"])

    keyed = files.where("feed_id is not null and file_id is not null and written_at is not null").select(
        F.col("feed_id").cast("long"), F.col("file_id").cast("long"), F.col("written_at").cast("timestamp_ntz").alias("written_at"), "payload")
    # An object without fields has no place in the order either: it has nothing that could change.
    return stage(keyed.mapInArrow(run, FILE_SCHEMA).where("size(items) > 0"))


def ordered_files(files: DataFrame) -> DataFrame:
    """``path_maps`` with ``idx``, the place of the file among the readable files of its feed, staged."""
    maps = path_maps(files)
    once = maps.groupBy("feed_id", "file_id").agg(F.min("written_at").alias("written_at"))
    order = global_ordinal(once, "feed_id", ["written_at", "file_id"], "idx").select("feed_id", "file_id", "idx")
    return stage(maps.drop("written_at").join(order, ["feed_id", "file_id"]).dropDuplicates(["feed_id", "file_id"]))


def _values(ordered: DataFrame, only: DataFrame, value: bool = False) -> DataFrame:
    """(feed_id, file_id, idx, path, jtype[, value]) of the fields ``only`` (feed_id, path); a feed's paths are one array, as wide as its schemas."""
    wanted = only.groupBy("feed_id").agg(F.collect_set("path").alias("wanted"))
    joined = ordered.join(checked_broadcast(wanted, MAX_SENT), "feed_id")
    kept = F.filter("items", lambda x: F.array_contains("wanted", x["path"]) & (x["jtype"] > 0))
    found = F.transform(kept, lambda x: F.struct(x["path"].alias("path"), x["jtype"].alias("jtype"), *([x["value"].alias("value")] if value else [])))
    return joined.select("feed_id", "file_id", "idx", F.explode(found).alias("x")).select("feed_id", "file_id", "idx", "x.*")


def _spans(ordered: DataFrame) -> DataFrame:
    """Per feed and path: first and last place, count, number of values, and the opening, closing, least and greatest JSON type.

    Place and type are one number, so that the aggregate keeps to plain numbers and combines before the shuffle.
    """
    values = ordered.select("feed_id", "idx", F.explode("items").alias("x")).select("feed_id", "idx", "x.path", "x.jtype")
    kind = F.when(F.col("jtype") > 0, F.col("jtype"))
    typed = F.when(F.col("jtype") > 0, F.col("idx") * 8 + F.col("jtype"))
    spans = values.groupBy("feed_id", "path").agg(
        F.min("idx").alias("first"), F.max("idx").alias("last"), F.count("*").alias("n"), F.count(kind).alias("n_values"),
        F.min(typed).alias("opening"), F.max(typed).alias("closing"), F.min(kind).alias("least"), F.max(kind).alias("greatest"))
    spans = spans.withColumn("opening", F.col("opening") % 8).withColumn("closing", F.col("closing") % 8)
    return spans.join(spans.groupBy("feed_id").agg(F.max("last").alias("feed_last")), "feed_id")


def _retyped(ordered: DataFrame, spans: DataFrame) -> DataFrame:
    """(feed_id, file_id, path): the first file of each new JSON type of a path.

    Paths of one type are settled by the spans. For the rest types are compared in blocks of BLOCK
    files, and across blocks through each block's last type, so no feed is one window.
    """
    several = spans.where("least <> greatest").select("feed_id", "path")
    typed = stage(_values(ordered, several).withColumn("block", F.expr(f"idx div {BLOCK}")))
    blocks = typed.groupBy("feed_id", "path", "block").agg((F.max(F.col("idx") * 8 + F.col("jtype")) % 8).alias("closing"))
    blocks = blocks.select("feed_id", "path", "block", F.lag("closing").over(W.partitionBy("feed_id", "path").orderBy("block")).alias("opening"))
    inside = W.partitionBy("feed_id", "path", "block").orderBy("idx")
    return (typed.withColumn("before", F.lag("jtype").over(inside))
            .join(blocks, ["feed_id", "path", "block"])
            .where("jtype <> coalesce(before, opening)")
            .select("feed_id", "file_id", "path"))


def _name_words(path: str) -> set[str]:
    return {w for w in re.findall(r"[a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", path).lower())}


def name_likeness(a: str, b: str) -> float:
    """Share of the words of two paths that one begins with the other's first three letters or more."""
    x, y = _name_words(a), _name_words(b)
    same = lambda p, q: p == q or (min(len(p), len(q)) >= 3 and (p.startswith(q) or q.startswith(p)))
    hits = sum(any(same(p, q) for q in y) for p in x) + sum(any(same(p, q) for p in x) for q in y)
    return hits / max(1, len(x) + len(y))


def _pair_up(pairs: list[dict]) -> list[tuple[str, str]]:
    """Greedy one-to-one matching of the ended and begun paths of one file, most alike first.

    A pair counts if its values overlap by ALIKE, its forms nearly always, or, where the names share a word, its forms
    by a share that grows with the number of values seen (a few values say little about a distribution).
    """
    rows = []
    for r in pairs:
        name, least = name_likeness(r["old"], r["new"]), ALIKE * r["seen"] / (r["seen"] + 3)
        best = max(r["shape"], r["value"], COARSE * r["coarse"])
        if r["value"] >= ALIKE or r["shape"] >= CERTAIN or (name > 0 and best >= least):
            rows.append((-(best + 0.3 * name), r["old"], r["new"]))
    old, new, out = set(), set(), []
    for _, a, b in sorted(rows):
        if a not in old and b not in new:
            old.add(a)
            new.add(b)
            out.append((a, b))
    return out


def _renamed(ordered: DataFrame, both: DataFrame) -> DataFrame:
    """(feed_id, at, old, new): pairs of ``both`` (paths that end and begin in one file, of one type) with alike values.

    Shares of values, of their forms and of their coarse forms are compared: each is hashed, counted by path and joined on its hash.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            forms = [(t, v, shape(t, v)) for t, v in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
            what = pa.ListArray.from_arrays(pa.array(range(0, 3 * len(forms) + 1, 3), pa.int32()), pa.array([x for t, v, f in forms for x in (v, f, coarse(t, v, f))], pa.string()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), what], names=["feed_id", "path", "what"])

    wanted = both.select("feed_id", F.col("old").alias("path")).union(both.select("feed_id", "new")).distinct()
    real = _values(ordered, wanted, value=True).select("feed_id", "path", "jtype", "value").mapInArrow(run, "feed_id long, path string, what array<string>")
    counts = stage(real.select("feed_id", "path", F.posexplode("what").alias("what", "x")).groupBy("feed_id", "path", "what", F.xxhash64("x").alias("h")).agg(F.count("*").alias("c")))
    old = counts.select("feed_id", F.col("path").alias("old"), "what", "h", F.col("c").alias("c_old"))
    new = counts.select("feed_id", F.col("path").alias("new"), "what", "h", F.col("c").alias("c_new"))
    overlap = F.least(F.col("c_old") / F.col("n_old"), F.col("c_new") / F.col("n_new"))
    alike = (both.join(old, ["feed_id", "old"]).join(new, ["feed_id", "new", "what", "h"])
             .groupBy("feed_id", "at", "old", "new").agg(F.min(F.least("n_old", "n_new")).alias("seen"), *(
                 F.sum(F.when(F.col("what") == i, overlap).otherwise(0.0)).alias(w) for i, w in enumerate(("value", "shape", "coarse")))))
    # A group is what ends and begins in one file: as wide as a schema, not as long as the data.
    groups = alike.groupBy("feed_id", "at").agg(F.collect_list(F.struct("old", "new", "seen", "value", "shape", "coarse")).alias("pairs"))

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(i, a, b) for i, pairs in enumerate(batch.column(2).to_pylist()) for a, b in _pair_up(pairs)]
            rows = batch.take(pa.array([i for i, _, _ in found], pa.int32()))
            yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), *(pa.array([f[k] for f in found], pa.string()) for k in (1, 2))], names=["feed_id", "at", "old", "new"])

    return groups.mapInArrow(match, "feed_id long, at long, old string, new string")


def _changes(ordered: DataFrame) -> DataFrame:
    spans = stage(_spans(ordered))
    solid = spans.where("last - first + 1 = n")
    ended = solid.where("last < feed_last").select("feed_id", (F.col("last") + 1).alias("at"), "path", "closing", "n_values")
    begun = solid.where("first > 0").select("feed_id", F.col("first").alias("at"), "path", "opening", "n_values")
    both = stage(ended.withColumnsRenamed({"path": "old", "n_values": "n_old"}).join(begun.withColumnsRenamed({"path": "new", "n_values": "n_new"}), ["feed_id", "at"])
                 .where("closing = opening").select("feed_id", "at", "old", "new", "n_old", "n_new"))
    renamed = stage(_renamed(ordered, both))
    removed = ended.join(renamed.select("feed_id", "at", F.col("old").alias("path")), ["feed_id", "at", "path"], "left_anti")
    added = begun.join(renamed.select("feed_id", "at", F.col("new").alias("path")), ["feed_id", "at", "path"], "left_anti")
    by_place = (removed.select("feed_id", "at", F.lit("removed").alias("change_kind"), F.col("path").alias("field_path"), F.lit("").alias("new_path"))
                .union(added.select("feed_id", "at", F.lit("added"), "path", F.lit("")))
                .union(renamed.select("feed_id", "at", F.lit("renamed"), "old", "new")))
    files = ordered.select("feed_id", F.col("idx").alias("at"), "file_id")
    placed = files.join(checked_broadcast(stage(by_place), MAX_SENT), ["feed_id", "at"]).select("feed_id", "file_id", "change_kind", "field_path", "new_path")
    retyped = _retyped(ordered, spans).select("feed_id", "file_id", F.lit("retyped").alias("change_kind"), F.col("path").alias("field_path"), F.lit("").alias("new_path"))
    return placed.union(retyped)


def schema_changes(files: DataFrame) -> DataFrame:
    """Every change of every feed: (feed_id, file_id, change_kind, field_path, new_path)."""
    return _changes(ordered_files(files))


def first_names(changes: DataFrame) -> DataFrame:
    """(feed_id, path, column): the first name of the chain of renames each renamed path stands in, staged."""
    chain = stage(changes.where("change_kind = 'renamed'").select("feed_id", F.col("new_path").alias("path"), F.col("field_path").alias("column")))
    while True:  # each round doubles the steps a row has gone back
        step = stage(chain.alias("a").join(chain.alias("b"), F.expr("a.feed_id = b.feed_id and a.column = b.path"), "left").select(
            "a.feed_id", "a.path", F.coalesce("b.column", "a.column").alias("column"), F.col("b.column").isNotNull().alias("more")))
        chain = step.drop("more")
        if step.where("more").limit(1).count() == 0:
            return chain


def _named(ordered: DataFrame, changes: DataFrame) -> DataFrame:
    """``ordered`` with ``column`` in every item: the steady name of its path. A feed's renames are one map, no larger than its schemas."""
    names = first_names(changes).groupBy("feed_id").agg(F.map_from_entries(F.collect_list(F.struct("path", "column"))).alias("names"))
    joined = ordered.join(checked_broadcast(names, MAX_SENT), "feed_id", "left")
    return joined.withColumn("items", F.transform("items", lambda x: x.withField("column", F.coalesce(F.try_element_at("names", x["path"]), x["path"])))).drop("names")


def steady_columns(named: DataFrame) -> list[tuple[str, int]]:
    """The steady columns and the type most of their values have: the schema of the result, as wide as the feeds have fields."""
    kinds = named.select(F.explode(F.transform("items", lambda x: F.struct(x["column"].alias("column"), x["jtype"].alias("jtype")))).alias("x")).select("x.*")
    kinds = kinds.where("jtype > 0").groupBy("column", "jtype").agg(F.count("*").alias("n"))
    top = kinds.groupBy("column").agg(F.max(F.struct("n", "jtype")).alias("t"))
    return sorted((r["column"], r["jtype"]) for r in top.select("column", "t.jtype").toLocalIterator())


SPARK_TYPE = {1: "string", 2: "boolean", 3: "double", 4: "string"}


def _cell(column: str, jtype: int) -> Column:
    return F.try_element_at("cells", F.lit(column)).try_cast(SPARK_TYPE[jtype]).alias(column.replace(".", "__"))


def steady_table(files: DataFrame) -> DataFrame:
    """One row per file with a steady, typed column per field; dots in names become double underscores."""
    ordered = ordered_files(files)
    named = stage(_named(ordered, _changes(ordered)))
    # Two paths of one column in one file (only keys that hold dots can make them): the first counts.
    keys = F.transform("items", lambda x: x["column"])
    once = F.filter(F.transform("items", lambda x, i: F.struct(x["column"].alias("k"), x["value"].alias("v"), i.alias("i"))), lambda e: F.array_position(keys, e["k"]) == e["i"] + 1)
    cells = named.select("feed_id", "file_id", "idx", F.size("items").cast("long").alias("n_fields"), F.map_from_entries(F.transform(once, lambda e: F.struct(e["k"], e["v"]))).alias("cells"))
    return cells.select("feed_id", "file_id", "idx", "n_fields", *(_cell(c, t) for c, t in steady_columns(named)))


def failed_casts(files: DataFrame) -> DataFrame:
    """Values their steady column cannot take: (feed_id, file_id, path, column, jtype, target, value)."""
    ordered = ordered_files(files)
    named = stage(_named(ordered, _changes(ordered)))
    columns = steady_columns(named)
    rows = named.select("feed_id", "file_id", F.explode("items").alias("x")).select("feed_id", "file_id", "x.*").where("jtype > 0")
    of_type = lambda c: F.element_at(F.array(*map(F.lit, TYPES[1:])), c)
    target = F.try_element_at(F.create_map(*(F.lit(x) for c in columns for x in c)), F.col("column")) if columns else F.lit(None).cast("int")
    lost = (((F.col("target") == 3) & F.col("value").try_cast("double").isNull()) | ((F.col("target") == 2) & F.col("value").try_cast("boolean").isNull())
            | ((F.col("target") == 1) & (F.col("jtype") != 1)))
    return rows.withColumn("target", target.cast("int")).where(lost).select(
        "feed_id", "file_id", "path", "column", of_type(F.col("jtype").cast("int")).alias("jtype"), of_type(F.col("target")).alias("target"), "value")
