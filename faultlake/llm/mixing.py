"""Mixing sources to target weights (problem 8).

Every document is measured in tokens of a public tokenizer. Token totals by cell (source, language, topic)
are raked by iterative proportional fitting: the sources to their target shares, languages and topics to
the shares they have in the corpus, no cell above what its source's ``max_repeats`` allows. A document's
expected number of copies is its cell's calibrated weight; whole copies are sure, the fraction is drawn by a
hash of the document's id, so the same documents give the same mixture on any cluster.

A source that stays below its target even at ``max_repeats`` is used that often and reported as short; the
others are not raised above their targets. Documents of sources without a target, and targets of null or
negative share, are left out; a null text counts 0 tokens; a source listed twice is one whose shares add up and whose
smallest repeat limit holds. Null languages and topics are cells of their own. Without documents every source is short
unless its share is 0.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from faultlake.session import checked_broadcast, stage

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: how byte-level BPE vocabularies cut text before merging.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
MAX_CELLS, MAX_VOCABULARY = 1_000_000, 64 << 20
#: Up to so many targets or weights are sent to the tasks; more are joined by shuffle.
MAX_SENT = 200_000
ROUNDS, CLOSE = 200, 1e-9


def _all_sources():
    """The whole of a table of sources, which has a row for each source of the targets and nothing of the documents."""
    return W.partitionBy()


@lru_cache(maxsize=2)
def encoder(vocabulary: bytes):
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, vocabulary.splitlines())}
    return tiktoken.Encoding("mixing", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def with_tokens(documents: DataFrame, text: str = "text", path: str = TOKENIZER, name: str = "n_tokens") -> DataFrame:
    """``documents`` with the number of tokens of ``text``. The vocabulary file is read by the driver and sent to the tasks, so only the driver needs it."""
    if os.path.getsize(path) > MAX_VOCABULARY:
        raise ValueError(f"{path} is no vocabulary of a size that can be sent to every task")
    with open(path, "rb") as file:
        shared = documents.sparkSession.sparkContext.broadcast(file.read())

    @F.pandas_udf("long")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encode = encoder(shared.value).encode_ordinary
        for texts in batches:
            yield pd.Series([0 if t is None else len(encode(t)) for t in texts], dtype="int64")

    return documents.withColumn(name, count(F.col(text)))


def targets_of(targets: DataFrame) -> DataFrame:
    """One row per source: (source, target_share, max_repeats), shares scaled to sum 1."""
    one = (targets.where("source is not null and target_share >= 0").groupBy("source")
           .agg(F.sum("target_share").alias("target_share"), F.min(F.greatest(F.coalesce("max_repeats", F.lit(1)), F.lit(0))).alias("max_repeats")))
    total = F.sum("target_share").over(_all_sources())
    return one.withColumn("target_share", F.when(total > 0, F.col("target_share") / total).otherwise(0.0))


def measured(documents: DataFrame, targets: DataFrame, topic: str, path: str = TOKENIZER) -> DataFrame:
    """(doc_id, source, lang, topic, n_tokens) of the documents whose source has a target, staged."""
    known = documents.where("doc_id is not null").join(checked_broadcast(targets.select("source"), MAX_SENT), "source", "left_semi")
    plain = known.select("doc_id", "source", F.coalesce(F.lower("lang"), F.lit("")).alias("lang"), F.coalesce(F.col(topic).cast("string"), F.lit("")).alias("topic"), "text")
    return stage(with_tokens(plain, path=path).drop("text"))


def rake(cells: pd.DataFrame, targets: pd.DataFrame) -> pd.DataFrame:
    """``cells`` (source, lang, topic, tokens) with ``weight``: expected copies of a document of the cell."""
    total = float(cells["tokens"].sum())
    limit = cells["source"].map(dict(zip(targets["source"], targets["max_repeats"], strict=True))).to_numpy(float)
    share = dict(zip(targets["source"], targets["target_share"], strict=True))
    tokens = cells["tokens"].to_numpy(float)
    most = tokens * limit
    margins = []
    for name in ("source", "lang", "topic"):
        codes, keys = pd.factorize(cells[name])
        have = np.bincount(codes, weights=tokens, minlength=len(keys))
        want = np.array([share[k] * total for k in keys]) if name == "source" else have
        margins.append((codes, want, np.bincount(codes, weights=most, minlength=len(keys))))
    reach = np.minimum(margins[0][1], margins[0][2])  # a short source gives all it may
    margins[0] = (margins[0][0], reach, margins[0][2])
    scale = reach.sum() / total if total else 0
    margins[1:] = [(c, w * scale, m) for c, w, m in margins[1:]]
    x = np.minimum(tokens, most)
    for _ in range(ROUNDS):
        before = x.copy()
        for codes, want, _ in reversed(margins):  # the sources last, so that their shares hold exactly
            have = np.bincount(codes, weights=x, minlength=len(want))
            x = np.minimum(x * np.where(have > 0, want / np.maximum(have, 1e-12), 0)[codes], most)
        if np.abs(x - before).max(initial=0) <= CLOSE * max(total, 1):
            break
    codes, want, _ = margins[0]
    for _ in range(ROUNDS):  # what the cells' limits cut off goes to the other cells of the source
        room = most - x
        lack = want - np.bincount(codes, weights=x, minlength=len(want))
        open_ = np.bincount(codes, weights=room, minlength=len(want))
        if not (lack > CLOSE * max(total, 1)).any():
            break
        x = x + room * np.clip(lack / np.maximum(open_, 1e-12), 0, 1)[codes]
    return cells.assign(weight=np.where(tokens > 0, x / np.maximum(tokens, 1e-12), 0.0), limit=limit)


def _fit(docs: DataFrame, targets: DataFrame) -> DataFrame:
    # Cells are kinds of documents, not documents: as many as sources x languages x topics, checked.
    cells = docs.groupBy("source", "lang", "topic").agg(F.sum("n_tokens").alias("tokens"))
    known = cells.limit(MAX_CELLS + 1).toPandas()
    if len(known) > MAX_CELLS:
        raise ValueError("the topic column has too many values for raking")
    schema = "source string, lang string, topic string, tokens long, weight double, limit double"
    spark = docs.sparkSession
    if not len(known):
        return spark.createDataFrame([], schema)
    fitted = rake(known.sort_values(["source", "lang", "topic"]), targets.toPandas())
    return spark.createDataFrame(fitted, schema)


def _uniform(key: str):
    return F.pmod(F.xxhash64(F.col(key), F.lit("mix")), F.lit(1 << 40)) / float(1 << 40)


def mixture(documents: DataFrame, targets: DataFrame, topic: str = "make", path: str = TOKENIZER) -> DataFrame:
    """(doc_id, source, n_tokens, weight, copies) of every document whose source has a target."""
    goal = targets_of(targets)
    docs = measured(documents, goal, topic, path)
    weights = _fit(docs, goal).select("source", "lang", "topic", "weight", "limit")
    joined = docs.join(checked_broadcast(weights, MAX_SENT), ["source", "lang", "topic"])
    copies = F.least(F.floor("weight") + (_uniform("doc_id") < F.col("weight") - F.floor("weight")).cast("long"), F.col("limit").cast("long"))
    return joined.select("doc_id", "source", "n_tokens", "weight", copies.cast("int").alias("copies"))


def shares(documents: DataFrame, targets: DataFrame, topic: str = "make", path: str = TOKENIZER) -> DataFrame:
    """Report by source: target and actual share, tokens there, usable and used, and whether it stays short.

    Usable is every document at max_repeats; a source is short if that is less than its share of the tokens of all documents with a target.
    """
    goal = targets_of(targets)
    mixed = mixture(documents, targets, topic, path)
    used = mixed.groupBy("source").agg(F.sum("n_tokens").alias("tokens"), F.sum(F.col("n_tokens") * F.col("copies")).alias("used"), F.max("copies").alias("most_copies"))
    full = goal.join(used, "source", "left").select(
        "source", "target_share", "max_repeats", *(F.coalesce(c, F.lit(0)).alias(c) for c in ("tokens", "used", "most_copies")))
    full = full.withColumn("_all", F.sum("tokens").over(_all_sources())).withColumn("_used", F.sum("used").over(_all_sources()))
    return full.select(
        "source", "target_share", "max_repeats", "tokens", "used", "most_copies",
        F.coalesce(F.col("used") / F.nullif(F.col("_used"), F.lit(0)), F.lit(0.0)).alias("actual_share"),
        ((F.col("tokens") * F.col("max_repeats") < F.col("target_share") * F.col("_all")) | ((F.col("_all") == 0) & (F.col("target_share") > 0))).alias("short"))
