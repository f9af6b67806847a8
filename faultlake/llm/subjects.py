"""Subject areas of documents (problem 9).

Five labelling functions vote on each sentence: the *words* and the *phrases* (pairs of neighbouring words) of a lexicon, the *section*
(what the sentences next to it in its section are about), the *address* (origin of the document) and its *source*. The lexicon's log odds are learned
from labelled documents sentence by sentence (each sentence is about one of its document's subjects, which one is latent and found by
expectation maximisation); address and source vote what most labelled documents of that origin or source have. A function that does not know, or
whose best subject leads by odds of less than ``ODDS``, does not vote.

A latent model learns from the agreement of the functions on all sentences (counts of vote patterns, so the data stay distributed) how often each
function knows the subject, and the base rates of its votes. The posterior of each sentence then comes from all votes, and a subject is
assigned if its posterior share of the document's own sentences is at least a third. Sentences that neither words nor phrases speak of are about no subject and not counted.
Splitting a text is no exact count of its sentences, so the share that stands for a third is the one between ``LEAST_SHARE`` and a third that agrees best with the labelled sample.

Passages of examination text (windows of five words that occur in the items) and sentences of fewer than
three words are not the document's own. The labelled sample is bounded by ``MAX_LABELLED`` documents, those with
the smallest hash of their id; everything else covers all documents. A document with null or empty text, or with no
known word, gets the subject its address and source give and otherwise the most frequent one, so every document
with an id has one or two; of several texts under one id the smallest counts. Labels of unknown documents or subjects are left out; without labels the result is empty.
Items of more than ``MAX_EXAM_WORDS`` words in all are refused (ValueError): their windows are sent to every task.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from faultlake.session import stage

MAX_LABELLED, MAX_SUBJECTS, MAX_EXAM_WORDS = 2500, 256, 5_000_000
SHARE, LEAST_SHARE = 1 / 3, 1 / 4
#: Rounds of the sentence model, odds from which a feature speaks for a subject and a vote is given, and least occurrences.
ROUNDS, ODDS, LEAST = 6, 4.0, 2
FUNCTIONS = ("words", "phrases", "section", "address", "source")
#: Accuracies from which learning starts.
START = (0.7, 0.7, 0.7, 0.7, 0.7)
EXAM, EXAM_GAP, LEAST_WORDS = 5, 12, 3

_WORD = re.compile(r"[^\W_]+")
_END = re.compile(r"[.!?…][\"»”')]*(?=\s)|\n")
_SECTION = re.compile(r"\n\s*\n")
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


class Ids(dict):
    """word -> number from 1 on; 0 for unknown words, which are not kept."""

    def __missing__(self, word: str) -> int:
        return 0

    def add(self, word: str) -> int:
        return self.setdefault(word, len(self) + 1)


def windows(ids: np.ndarray) -> np.ndarray:
    """Hashes of all windows of EXAM words."""
    if len(ids) < EXAM:
        return np.zeros(0, dtype=np.uint64)
    h = np.zeros(len(ids) - EXAM + 1, dtype=np.uint64)
    for k in range(EXAM):
        h = (h ^ ids[k:len(ids) - EXAM + 1 + k].astype(np.uint64)) * _MULTIPLIER
        h ^= h >> np.uint64(29)
    return h


def among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Places of ``values`` in the sorted ``known``, -1 where absent."""
    if not len(known):
        return np.full(len(values), -1)
    place = np.minimum(np.searchsorted(known, values), len(known) - 1)
    return np.where(known[place] == values, place, -1)


class Texts:
    """Own sentences of a batch of texts as flat arrays: word ids, and the document and section of each sentence."""

    def __init__(self, texts: list[str | None], ids: Ids, exam: np.ndarray, exam_words: int) -> None:
        """``exam``: hashes of the windows of the items, whose words have the numbers 1 to ``exam_words``."""
        words: list[str] = []
        lengths, documents, sections = [], [], []
        section = 0
        for d, text in enumerate(texts):
            for part in _SECTION.split(text.lower()) if text else ():
                section += 1
                for sentence in _END.split(part):
                    if found := _WORD.findall(sentence):
                        words += found
                        lengths.append(len(found))
                        documents.append(d)
                        sections.append(section)
        self.words = words
        self.ids = np.fromiter(map(ids.__getitem__, words), np.int64, len(words))
        self.lengths, self.documents, self.sections = (np.array(x, dtype=np.int64) for x in (lengths, documents, sections))
        self.sentence = np.repeat(np.arange(len(lengths)), self.lengths)
        own = self.lengths >= LEAST_WORDS
        if len(self.ids) and len(exam):
            of = self.documents[self.sentence]
            known = np.cumsum(np.concatenate([[0], (self.ids > 0) & (self.ids <= exam_words)]))
            hits = np.flatnonzero(known[EXAM:] - known[:-EXAM] == EXAM)
            hits = hits[among(windows(self.ids)[hits], exam) >= 0]
            hits = hits[of[hits] == of[hits + EXAM - 1]]
            if len(hits):  # a gap of up to EXAM_GAP words between two windows belongs to the passage
                end = hits + EXAM
                joined = np.zeros(len(hits), dtype=bool)
                joined[:-1] = (of[hits[:-1]] == of[hits[1:]]) & (hits[1:] - end[:-1] <= EXAM_GAP)
                end[:-1] = np.where(joined[:-1], np.maximum(end[:-1], hits[1:]), end[:-1])
                cover = np.zeros(len(self.ids) + 1, dtype=np.int64)
                np.add.at(cover, hits, 1)
                np.add.at(cover, end, -1)
                inside = np.cumsum(cover[:-1]) > 0
                own &= 2 * np.bincount(self.sentence, weights=inside, minlength=len(own)) < self.lengths
        self.own = own


def features(sentence: list[str]) -> set[str]:
    """Words and pairs of neighbouring words without numbers."""
    known = [not x[0].isdigit() for x in sentence]
    return {x for x, k in zip(sentence, known, strict=True) if k} | {
        f"{a} {b}" for a, b, p, q in zip(sentence, sentence[1:], known, known[1:], strict=False) if p and q}


class Lexicon:
    """Log odds of words and phrases for each of ``k`` subjects."""

    def __init__(self, weights: dict[str, np.ndarray], k: int) -> None:
        self.weights, self.k = weights, k

    @classmethod
    def learn(cls, documents: list[tuple[list[list[str]], list[int]]], k: int) -> Lexicon:
        """``documents``: own sentences and subjects (0..k-1) of each labelled document."""
        ids: dict[str, int] = {}
        feature, sentence, labels = [], [], []
        for sentences, subjects in documents:
            for s in sentences:
                fs = [ids.setdefault(f, len(ids)) for f in features(s)]
                feature.extend(fs)
                sentence.extend([len(labels)] * len(fs))
                labels.append(subjects)
        if not feature:
            return cls({}, k)
        f, s = np.array(feature), np.array(sentence)
        often = np.bincount(f, minlength=len(ids)) >= LEAST
        f, s = f[often[f]], s[often[f]]
        allowed = np.zeros((len(labels), k))
        for i, subjects in enumerate(labels):
            allowed[i, subjects] = 1
        resp = allowed / allowed.sum(axis=1, keepdims=True)
        log_odds = np.zeros((len(ids), k))
        for round_ in range(ROUNDS):
            prior = np.maximum(resp.sum(axis=0) / len(labels), 1e-6)
            counts = np.stack([np.bincount(f, weights=resp[s, j], minlength=len(ids)) for j in range(k)], axis=1)
            share = (counts + 0.3 * prior) / (counts.sum(axis=1, keepdims=True) + 0.3)
            log_odds = np.log(share / prior + 1e-3)
            ratio = share / np.maximum(1 - share, 1e-9) * (1 - prior) / prior
            log_odds[ratio.max(axis=1) < ODDS] = 0
            if round_ < ROUNDS - 1:
                score = np.stack([np.bincount(s, weights=log_odds[f, j], minlength=len(labels)) for j in range(k)], axis=1)
                score = np.where(allowed > 0, score, -np.inf)
                resp = np.exp(score - score.max(axis=1, keepdims=True))
                resp /= resp.sum(axis=1, keepdims=True)
        kept = {w: log_odds[i] for w, i in ids.items() if often[i] and log_odds[i].any()}
        return cls(kept, k)

    def tables(self, ids: Ids) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Weights by word id, sorted keys of phrases and their weights; words are added to ``ids``."""
        for feature in self.weights:
            for word in feature.split(" "):
                ids.add(word)
        of_words = np.zeros((len(ids) + 1, self.k), dtype=np.float32)
        phrases: dict[int, np.ndarray] = {}
        for feature, weight in self.weights.items():
            a, *b = (ids[w] for w in feature.split(" "))
            if b:
                phrases[a * (len(ids) + 1) + b[0]] = weight
            else:
                of_words[a] = weight
        keys = np.array(sorted(phrases), dtype=np.int64)
        return of_words, keys, np.array([phrases[x] for x in keys.tolist()], dtype=np.float32).reshape(len(keys), self.k)


def summed(sentence: np.ndarray, feature: np.ndarray, weights: np.ndarray, n: int) -> np.ndarray:
    """Sums of weights (n sentences x subjects) over the distinct features of each sentence."""
    out = np.zeros((n, weights.shape[1]), dtype=np.float32)
    if len(feature):
        pairs = np.sort(sentence * len(weights) + feature)
        at, feature = np.divmod(pairs[np.diff(pairs, prepend=-1) > 0], len(weights))
        starts = np.flatnonzero(np.diff(at, prepend=-1))
        out[at[starts]] = np.add.reduceat(weights[feature], starts, axis=0)
    return out


def vote(scores: np.ndarray) -> np.ndarray:
    """The subject that leads by odds of ODDS or more, else -1."""
    if not len(scores):
        return np.zeros(0, dtype=np.int16)
    top = scores.argmax(axis=1)
    best = scores[np.arange(len(scores)), top]
    rest = scores.copy()
    rest[np.arange(len(scores)), top] = -np.inf
    second = rest.max(axis=1) if scores.shape[1] > 1 else np.zeros(len(scores))
    return np.where((best > 0) & (best - np.maximum(second, -1e9) >= np.log(ODDS)), top, -1).astype(np.int16)


def log_votes(votes: np.ndarray, alpha: np.ndarray, rate: np.ndarray) -> np.ndarray:
    """Log likelihood (rows x subjects) of votes; -1 says nothing."""
    out = np.zeros((len(votes), rate.shape[1]))
    for j in range(votes.shape[1]):
        given = np.flatnonzero(votes[:, j] >= 0)
        v = votes[given, j]
        part = np.repeat(((1 - alpha[j]) * rate[j, v])[:, None], rate.shape[1], axis=1)
        part[np.arange(len(given)), v] += alpha[j]
        out[given] += np.log(np.maximum(part, 1e-12))
    return out


class Latent:
    """Prior of the subjects, and of each function its accuracy and the base rate of its votes.

    A function knows a sentence's subject with its accuracy and votes it then; else it votes by its base rate, whatever the subject is.
    Without the base rate a function that always votes the same would seem to explain all.
    """

    def __init__(self, k: int) -> None:
        self.prior, self.alpha, self.rate = np.full(k, 1 / k), np.array(START), np.full((len(FUNCTIONS), k), 1 / k)

    def learn(self, votes: np.ndarray, n: np.ndarray, rounds: int = 50) -> None:
        """EM over patterns of votes (-1: no vote) and how often each occurs."""
        k = len(self.prior)
        if not len(votes):
            return
        for j in range(len(FUNCTIONS)):
            given = votes[:, j] >= 0
            counts = np.bincount(votes[given, j], weights=n[given], minlength=k) + 1e-3
            self.rate[j] = counts / counts.sum()
        for _ in range(rounds):
            weight = self.posterior(votes) * n[:, None]
            self.prior = np.maximum(weight.sum(axis=0), 1e-9)
            self.prior /= self.prior.sum()
            for j in range(len(FUNCTIONS)):
                given = np.flatnonzero(votes[:, j] >= 0)
                if len(given):
                    v = votes[given, j]
                    knew = self.alpha[j] / (self.alpha[j] + (1 - self.alpha[j]) * self.rate[j, v]) * weight[given, v]
                    self.alpha[j] = np.clip(knew.sum() / n[given].sum(), 1e-3, 0.999)

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        post = np.log(self.prior) + log_votes(votes, self.alpha, self.rate)
        post = np.exp(post - post.max(axis=1, keepdims=True))
        return post / post.sum(axis=1, keepdims=True)


class Model:
    """All labelling functions, learned from the labelled sample."""

    def __init__(self, sample: pd.DataFrame, subjects: list[int], exam: list[str | None]) -> None:
        self.subjects, self.ids = subjects, Ids()
        place = {s: j for j, s in enumerate(subjects)}
        k = len(subjects)
        grams = [windows(np.array([self.ids.add(x) for x in _WORD.findall((t or "").lower())], dtype=np.int64)) for t in exam]
        self.exam = np.unique(np.concatenate(grams)) if grams else np.zeros(0, np.uint64)
        self.exam_words = len(self.ids)
        labels = [[place[s] for s in own if s in place] for own in sample["labels"]]
        self.by_address, self.by_source = (self._majority(sample[c], labels) for c in ("origin", "source"))
        self.lexicon = Lexicon.learn([(s, y) for s, y in zip(self.own_sentences(sample["text"].tolist()), labels, strict=True) if y], k)
        self.of_words, self.phrases, self.of_phrases = self.lexicon.tables(self.ids)
        # which word ids have a weight of their own, and which open and close phrases
        self.speaks, self.opens, self.closes = self.of_words.any(axis=1), *np.zeros((2, len(self.of_words)), dtype=bool)
        first, last = np.divmod(self.phrases, len(self.of_words))
        self.opens[first], self.closes[last] = True, True
        self.latent, self.cut = Latent(k), SHARE

    @staticmethod
    def _majority(keys: pd.Series, labels: list[list[int]]) -> dict[str, int]:
        counts: dict[str, Counter] = defaultdict(Counter)
        for key, own in zip(keys, labels, strict=True):
            if key is not None:
                counts[key].update(own)
        return {key: c.most_common(1)[0][0] for key, c in counts.items() if sum(c.values()) > 1}

    def own_sentences(self, texts: list[str | None]) -> list[list[list[str]]]:
        """Words of each sentence that is the document's own, by document."""
        found = Texts(texts, self.ids, self.exam, self.exam_words)
        ends = np.cumsum(found.lengths)
        out: list[list[list[str]]] = [[] for _ in texts]
        for s in np.flatnonzero(found.own):
            out[found.documents[s]].append(found.words[ends[s] - found.lengths[s]:ends[s]])
        return out

    def votes(self, texts: list[str | None], origins: list[str | None], sources: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Votes (own sentences x functions), and the document of each sentence."""
        found = Texts(texts, self.ids, self.exam, self.exam_words)
        n = len(found.lengths)
        known = np.flatnonzero(self.speaks[found.ids])
        words = summed(found.sentence[known], found.ids[known], self.of_words, n)
        pair = np.flatnonzero(self.opens[found.ids[:-1]] & self.closes[found.ids[1:]] & (found.sentence[1:] == found.sentence[:-1]))
        place = among(found.ids[pair] * np.int64(len(self.of_words)) + found.ids[pair + 1], self.phrases)
        pair, place = pair[place >= 0], place[place >= 0]
        phrases = summed(found.sentence[pair], place, self.of_phrases, n)
        own = np.flatnonzero(found.own)
        documents, sections, both = found.documents[own], found.sections[own], vote((words + phrases)[own])
        before, after = np.full(len(own), -1, np.int16), np.full(len(own), -1, np.int16)
        same = sections[1:] == sections[:-1]
        before[1:], after[:-1] = np.where(same, both[:-1], -1), np.where(same, both[1:], -1)
        section = np.where(before < 0, after, np.where((after < 0) | (after == before), before, -1))
        rest = [np.array([table.get(x, -1) for x in keys], dtype=np.int16)[documents] if len(own) else np.zeros(0, np.int16)
                for table, keys in ((self.by_address, origins), (self.by_source, sources))]
        return np.stack([vote(words[own]), vote(phrases[own]), section, *rest], axis=1).astype(np.int16), documents

    def shares(self, votes: np.ndarray, documents: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Posterior shares (n documents x subjects) of the counted sentences, and how many are counted."""
        counted = (votes[:, :2] >= 0).any(axis=1)
        post, at = self.latent.posterior(votes[counted].astype(np.int64)), documents[counted]
        counts = np.bincount(at, minlength=n)
        shares = np.stack([np.bincount(at, weights=post[:, j], minlength=n) for j in range(len(self.subjects))], axis=1)
        return shares / np.maximum(counts, 1)[:, None], counts

    def fit_cut(self, sample: pd.DataFrame) -> None:
        """The share from LEAST_SHARE to SHARE that agrees with most labels on second subjects; the middle of the best ones."""
        votes, documents = self.votes(sample["text"].tolist(), sample["origin"].tolist(), sample["source"].tolist())
        shares, counts = self.shares(votes, documents, len(sample))
        if len(self.subjects) < 2:
            return
        order = np.argsort(-shares, axis=1, kind="stable")
        second = shares[np.arange(len(shares)), order[:, 1]]
        two = np.array([self.subjects[j] in own and len(own) > 1 for j, own in zip(order[:, 1], sample["labels"], strict=True)])
        tries = np.linspace(LEAST_SHARE, SHARE, 200) - 1e-6
        agree = np.array([((second >= c) == two)[counts > 0].sum() for c in tries])
        best = tries[agree == agree.max()]
        self.cut = float(best[len(best) // 2])

    def assign(self, votes: np.ndarray, documents: np.ndarray, rest: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(document, subject, share) of the one or two subjects of each; ``rest`` has the address and source votes of each document."""
        n = len(rest)
        shares, counts = self.shares(votes, documents, n)
        none = np.flatnonzero(counts == 0)
        alone = np.full((len(none), len(FUNCTIONS)), -1)
        alone[:, 3:] = rest[none]
        shares[none] = self.latent.posterior(alone)
        order = np.argsort(-shares, axis=1, kind="stable")[:, :2]
        ranked = np.take_along_axis(shares, order, axis=1)
        given = ranked >= self.cut
        given[:, 0] = True
        given[none, 1:] = False
        at, rank = np.nonzero(given)
        return at, np.array(self.subjects, dtype=np.int32)[order[at, rank]], ranked[at, rank]


def learn(documents: DataFrame, labels: DataFrame, subjects: DataFrame, items: DataFrame) -> tuple[Model, pd.DataFrame] | None:
    """The labelling functions, from at most ``MAX_LABELLED`` labelled documents, and these."""
    ids = sorted(int(r[0]) for r in subjects.where("subject_id is not null").select("subject_id").distinct().limit(MAX_SUBJECTS + 1).collect())
    if len(ids) > MAX_SUBJECTS:
        raise ValueError("too many subjects")
    n_words = items.select(F.sum(F.size(F.split("text", r"\s+")))).first()[0] or 0
    if n_words > MAX_EXAM_WORDS:
        raise ValueError("the evaluation items are too many to be sent to every task; split them into sets")
    exam = [r[0] for r in items.select("text").distinct().toLocalIterator()]
    known = labels.where("doc_id is not null").where(F.col("subject_id").isin(ids))
    chosen = known.groupBy("doc_id").agg(F.sort_array(F.collect_set("subject_id")).alias("labels"))
    chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(MAX_LABELLED)
    sample = documents.select("doc_id", "text", "origin", "source").join(F.broadcast(chosen), "doc_id")  # MAX_LABELLED rows
    sample = sample.groupBy("doc_id").agg(F.min(F.struct("text", "origin", "source")).alias("d"), F.first("labels").alias("labels")).select("doc_id", "d.*", "labels").toPandas()
    if not len(sample) or not ids:
        return None
    sample = sample.sort_values("doc_id").astype(object).where(sample.notna(), None)
    return Model(sample, ids, exam), sample


def voted(documents: DataFrame, model: Model) -> DataFrame:
    """(doc_id, address, source, votes) of every document, staged: texts are read once."""
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            texts, origins, sources = (batch.column(i).to_pylist() for i in (1, 2, 3))
            votes, of = model.votes(texts, origins, sources)
            cuts = np.searchsorted(of, np.arange(len(texts) + 1))
            packed = [votes[a:b, :3].tobytes() for a, b in zip(cuts, cuts[1:], strict=False)]
            rest = [pa.array([table.get(x, -1) for x in keys], pa.int16()) for table, keys in ((model.by_address, origins), (model.by_source, sources))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *rest, pa.array(packed, pa.binary())], names=["doc_id", "address", "source", "votes"])

    plain = documents.where("doc_id is not null").select(F.col("doc_id").cast("long"), "text", "origin", "source")
    found = stage(plain.mapInArrow(run, "doc_id long, address short, source short, votes binary"))
    return found.groupBy("doc_id").agg(F.min(F.struct("votes", "address", "source")).alias("v")).select("doc_id", "v.address", "v.source", "v.votes")


def _unpacked(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Votes of all functions by sentence, the document of each sentence, and the documents' own votes of address and source."""
    rows = batch.column("votes").to_pylist()
    own = np.frombuffer(b"".join(rows), dtype=np.int16).reshape(-1, 3)
    rest = np.stack([np.asarray(batch.column(c), dtype=np.int16) for c in ("address", "source")], axis=1)
    documents = np.repeat(np.arange(len(rows)), [len(x) // 6 for x in rows])
    return np.concatenate([own, rest[documents]], axis=1), documents, rest


def patterns(found: DataFrame) -> DataFrame:
    """Vote patterns of all counted sentences and how often each occurs: at most (subjects + 1) ** 5 rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            votes, _, _ = _unpacked(batch)
            kinds, n = np.unique(votes[(votes[:, :2] >= 0).any(axis=1)], axis=0, return_counts=True)
            yield pa.RecordBatch.from_arrays([*(pa.array(kinds[:, j].astype(np.int32)) for j in range(len(FUNCTIONS))), pa.array(n)], names=[*FUNCTIONS, "n"])

    return found.mapInArrow(run, ", ".join(f"{f} int" for f in FUNCTIONS) + ", n long").groupBy(*FUNCTIONS).agg(F.sum("n").alias("n"))


def document_subjects(documents: DataFrame, labels: DataFrame, subjects: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, subject_id, share) of every document; a document given twice comes out once."""
    schema = "doc_id long, subject_id int, share double"
    learned = learn(documents, labels, subjects, items)
    if learned is None:
        return documents.sparkSession.createDataFrame([], schema)
    model, sample = learned
    found = stage(voted(documents, model))
    counted = patterns(found).toPandas().sort_values(list(FUNCTIONS))
    model.latent.learn(counted[list(FUNCTIONS)].to_numpy(), counted["n"].to_numpy(dtype=float))
    model.fit_cut(sample)
    for name in ("ids", "exam", "lexicon", "of_words", "phrases", "of_phrases", "speaks", "opens", "closes"):  # not needed in the tasks any more
        delattr(model, name)
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, subject, share = shared.value.assign(*_unpacked(batch))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(at)), pa.array(subject), pa.array(share)], names=["doc_id", "subject_id", "share"])

    return found.mapInArrow(run, schema)


def composition(documents: DataFrame, found: DataFrame, subjects: DataFrame) -> DataFrame:
    """(subject, n_documents, n_chars): what each subject holds of the corpus, a document of two counting half for each."""
    part = found.withColumn("part", F.lit(1.0) / F.count("*").over(W.partitionBy("doc_id")))
    return (part.join(documents.select("doc_id", "n_chars"), "doc_id").groupBy("subject_id")
            .agg(F.sum("part").alias("n_documents"), F.sum(F.col("part") * F.col("n_chars")).alias("n_chars"))
            .join(subjects.select("subject_id", "subject"), "subject_id").select("subject", "n_documents", "n_chars"))
