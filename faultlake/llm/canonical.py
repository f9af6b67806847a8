"""Mapping free-entered values to a canonical list (problem 4).

A multi-pattern automaton over canonical names and aliases finds the makes and models mentioned in the two
fields, whichever field they stand in; the longest non-overlapping mention wins. What is left goes to
token-set similarity within the models of the make, or within all models where no make is known: a name is the set of its
pairs of near letters, two sets are as alike as twice what they share is of both sizes, and an index from tokens to names finds those that share any.
Digits must agree exactly, so neighbours like "Courier 1" and "Courier 2" are never confused.

Each distinct pair of values is matched once and joined back to its rows. A canonical list of more than ``MAX_ENTRIES`` names is refused (ValueError): its
automaton is built in every task. Rows with both fields null give no result; a value naming nothing, or a
model of several makes without its make, gives 0. Values are never dropped.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultlake.session import checked_broadcast, stage

MAX_ENTRIES = 200_000
#: Up to so many distinct pairs of values are sent to the tasks; more are joined by shuffle.
MAX_SENT = 200_000

# Cyrillic and Greek letters that look like Latin ones.
LOOKALIKES = str.maketrans("АВСЕНІЈКМОРЅТХУавсеніјкморѕтхуΑΒΕΖΗΙΚΜΝΟΡΤΥΧο", "ABCEHIJKMOPSTXYabcehijkmopstxyABEZHIKMNOPTYXo")
#: Least similarity of names: within the models of a known make or among makes, and among all models.
SIMILAR, SIMILAR_ALL = 0.5, 0.6
#: Names of up to so many letters have too few tokens to be compared; all must agree.
SHORT = 4


def normal(value: str | None) -> str:
    """Lower case without accents, look-alike letters or punctuation; words separated by one space."""
    text = unicodedata.normalize("NFKD", unicodedata.normalize("NFKC", value or "").translate(LOOKALIKES)).casefold()
    text = "".join(c for c in text if not unicodedata.combining(c)).translate(str.maketrans({"ø": "o", "ł": "l", "đ": "d"}))
    words = re.findall(r"[^\W_]+", text)
    return " ".join(_misread(w) for w in words)


def _misread(word: str) -> str:
    """0 and 1 between the letters of a longer word are o and l."""
    if len(word) < 4 or re.search(r"[2-9]", word):
        return word
    return re.sub(r"(?<=[a-z])[01]{1,2}(?=[a-z])", lambda m: m[0].replace("0", "o").replace("1", "l"), word)


def _letters(text: str) -> str:
    return re.sub(r"[^a-z]", "", text)


def _digits(text: str) -> str:
    return re.sub(r"\D+", " ", text).strip()


def tokens(letters: str) -> frozenset[str]:
    """Pairs of letters next to each other or one apart, the ends counting as letters, so that a swap or slip leaves most of them."""
    marked = f"^{letters}$"
    return frozenset(marked[i] + marked[j] for i in range(len(marked)) for j in (i + 1, i + 2) if j < len(marked)) if letters else frozenset()


class Names:
    """An index from tokens to names, by a key that must agree exactly."""

    def __init__(self) -> None:
        self.names: list[tuple[object, int]] = []
        self.holding: dict[tuple[object, str], list[int]] = {}

    def add(self, key: object, letters: str, meant: object) -> None:
        own = tokens(letters)
        self.names.append((meant, len(own)))
        for token in own:
            self.holding.setdefault((key, token), []).append(len(self.names) - 1)

    def alike(self, key: object, letters: str) -> list[tuple[float, int, object]]:
        """(similarity, tokens shared less tokens missing, what is meant) of all names under ``key`` that share a token with ``letters``."""
        own = tokens(letters)
        shared = Counter(chain.from_iterable(self.holding.get((key, token), ()) for token in own))
        return [(2 * n / (len(own) + self.names[i][1]), 2 * n - self.names[i][1], self.names[i][0]) for i, n in shared.items()]


class Matcher:
    """The automaton and the similarity search over one list of (model_id, make, model)."""

    def __init__(self, entries: list[tuple[int, str, str]]) -> None:
        self.by_make: dict[str, list[tuple[int, str]]] = {}
        self.by_model: dict[str, list[tuple[int, str]]] = {}
        self.makes, self.models = Names(), Names()
        self.sizes: set[int] = set()
        aliases: dict[str, set[tuple[str, str]]] = {}
        for number, make, model in entries:
            a, b = normal(make), normal(model)
            if not b:
                continue
            if a not in self.by_make:
                self.makes.add(None, _letters(a), a)
            self.by_make.setdefault(a, []).append((number, b))
            self.by_model.setdefault(b, []).append((number, a))
            if len(_letters(b)) > 2:
                for key in ((a, _digits(b)), _digits(b)):
                    self.models.add(key, _letters(b), (number, a, len(_letters(b))))
                self.sizes.add(len(b.split()))
            for kind, name in (("make", a), ("model", b)):
                if name:
                    for alias in {name, name.replace(" ", "")}:
                        aliases.setdefault(alias, set()).add((kind, name))
        self.automaton = ahocorasick.Automaton()
        for alias, meant in aliases.items():
            self.automaton.add_word(f" {alias} ", (len(alias), sorted(meant)))
        if aliases:
            self.automaton.make_automaton()
        self.empty = not aliases

    def mentions(self, text: str) -> list[tuple[str, str, int, int]]:
        """(kind, name, start, end) of the longest non-overlapping mentions in a normal text."""
        if self.empty or not text:
            return []
        found = [(end - n, n, meant) for end, (n, meant) in self.automaton.iter(f" {text} ")]
        out, taken = [], []
        for start, n, meant in sorted(found, key=lambda x: (-x[1], x[0])):
            if all(start >= b or start + n <= a for a, b in taken):
                taken.append((start, start + n))
                out.extend((kind, name, start, start + n) for kind, name in meant)
        return sorted(out, key=lambda x: (x[2], x[0]))

    def make_of(self, text: str) -> str | None:
        """The make a text is a slip or a shortening of."""
        if not text:
            return None
        compact, words = _letters(text), text.split()
        tries = {compact, *(w for w in (_letters("".join(words[:k])) for k in range(1, 4)) if len(w) > 3)}
        best = [(n, m) for t in tries for n, _, m in self.makes.alike(None, t) if n >= SIMILAR_ALL]
        if not best and len(compact) >= 3:
            best = [(0, m) for m in self.by_make if _letters(m).startswith(compact)]
        top = max((n for n, _ in best), default=0)
        meant = {m for n, m in best if n == top}
        return meant.pop() if len(meant) == 1 else None

    def closest(self, text: str, makes: list[str] | None) -> list[tuple[int, str]]:
        """Entries most alike to ``text`` by its tokens, with equal digits: (model_id, make); several only where they are equally alike."""
        words = text.split()
        tries = {text}
        for size in {m for n in self.sizes for m in (n - 1, n, n + 1) if m > 0}:  # the words of the name may be split, joined or stand among others
            tries.update(" ".join(words[i:i + size]) for i in range(len(words) - size + 1))
        least = SIMILAR_ALL if makes is None else SIMILAR
        found: dict[tuple[int, str], tuple[int, float]] = {}
        for t in tries:
            letters, digits = _letters(t), _digits(t.replace(" ", ""))
            for key in [digits] if makes is None else [(m, digits) for m in makes]:
                for n, gain, (number, make, size) in self.models.alike(key, letters):
                    if n >= (1 if size <= SHORT else least):
                        found[number, make] = max(found.get((number, make), (-1000, 0.0)), (gain, n))
        top = max(found.values(), default=None)
        return sorted(e for e, n in found.items() if n == top)

    @lru_cache(maxsize=100_000)  # noqa: B019
    def find(self, make: str | None, model: str | None) -> int:
        """The model_id meant, or 0."""
        a, b = normal(make), normal(model)
        seen = [*self.mentions(b), *self.mentions(a)]
        makes = list(dict.fromkeys(name for kind, name, *_ in seen if kind == "make"))
        models = [(name, e - s) for kind, name, s, e in seen if kind == "model"]
        if not makes and (guess := self.make_of(a) or self.make_of(b)):
            makes = [guess]
        for name, _ in sorted(models, key=lambda x: -x[1]):
            entries = self.by_model[name]
            own = [n for n, m in entries if m in makes]
            if len(own) == 1:
                return own[0]
            if len(entries) == 1 and not makes:
                return entries[0][0]
        for text in (b, a):
            for m in makes:  # the make's own words are no part of the model's name
                text = re.sub(rf"(^| ){re.escape(m)}( |$)", " ", text).strip()
            hits = self.closest(text, makes or None) if text else []
            if len(hits) == 1:
                return hits[0][0]
            if not makes and hits:
                return 0
        for name, _ in models:  # a model named in full with a make that has none of that name
            if len(self.by_model[name]) == 1:
                return self.by_model[name][0][0]
        return 0


def match_models(rows: DataFrame, make: str, model: str, entries: DataFrame) -> DataFrame:
    """``rows`` with ``model_id``. ``make`` and ``model`` are column expressions of ``rows``.

    Distinct pairs of values are matched and joined back, by broadcast where they are few; a pair that a third of all rows have is one row of the smaller side.
    """
    listed = [(int(r[0]), r[1] or "", r[2] or "") for r in entries.where("model_id is not null and model is not null").select("model_id", "make", "model").limit(MAX_ENTRIES + 1).collect()]
    if len(listed) > MAX_ENTRIES:
        raise ValueError("the canonical list is too long to be sent to the tasks")
    shared = rows.sparkSession.sparkContext.broadcast(listed)

    @F.pandas_udf("int")
    def found(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        matcher = Matcher(shared.value)
        for a, b in batches:
            yield pd.Series([matcher.find(x, y) for x, y in zip(a, b, strict=True)], dtype="int32")

    keyed = rows.withColumns({"_make": F.expr(make).cast("string"), "_model": F.expr(model).cast("string")})
    pairs = keyed.groupBy("_make", "_model").agg(F.lit(1).alias("_n"))
    matched = stage(pairs.select("_make", "_model", found("_make", "_model").alias("model_id")))
    small = matched.select(F.col("_make").alias("_a"), F.col("_model").alias("_b"), "model_id")
    return keyed.join(checked_broadcast(small, MAX_SENT), F.col("_make").eqNullSafe(F.col("_a")) & F.col("_model").eqNullSafe(F.col("_b"))).select(*rows.columns, "model_id")


def manual_models(manuals: DataFrame, entries: DataFrame) -> DataFrame:
    """(document_id, model_id) of every manual with a make or model; one row per document."""
    named = manuals.where("document_id is not null and (vehicle.make is not null or vehicle.model is not null)")
    named = named.select("document_id", F.col("vehicle.make").alias("make"), F.col("vehicle.model").alias("model")).dropDuplicates(["document_id"])
    return match_models(named, "make", "model", entries).select("document_id", "model_id")


def unmatched(manuals: DataFrame, entries: DataFrame) -> DataFrame:
    """(make, model, n): the values that match none, with the number of manuals that have them."""
    named = manuals.where("document_id is not null and (vehicle.make is not null or vehicle.model is not null)")
    named = named.select("document_id", F.col("vehicle.make").alias("make"), F.col("vehicle.model").alias("model")).dropDuplicates(["document_id"])
    counted = named.groupBy("make", "model").agg(F.count("*").alias("n"))
    return match_models(counted, "make", "model", entries).where("model_id = 0").drop("model_id")
