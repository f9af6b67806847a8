"""Main bodies, leaks, mixing and subjects on small hand-made tables."""

import datetime as dt
import random

import numpy as np
import pandas as pd
import pytest

from faultlake.llm import leaks as L
from faultlake.llm import mainbody as M
from faultlake.llm import mixing as X
from faultlake.llm import subjects as S

ARTICLE = "article_id long, content string"


def page(i, rng):
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    body = [f"The {word()} of the {word()} ran dry near mile {rng.randint(0, 9999)}, so the {word()} was changed." for _ in range(6)]
    lines = ["Home", "Shop | Blog | Contact", f"by Ann | 2020-01-0{i % 9 + 1} | 3 comments", "Symptoms", *body[:3], "• P0A0D – pump", "Fig. 2: the seal", "Parts used", *body[3:], "Advertisement", body[0] + " Again.", "Done.",
             f"Pump {i}, seal – The pump… Read more »", f"Seal {i} (12)", "Follow us", "All rights reserved.", f"© 2020 site{i}"]
    own = {4, 5, 6, 7, 8, 9, 10, 11, 12, 13, 15, 16}
    return "\n".join(lines), own


def test_main_lines(spark):
    rng = random.Random(3)
    made = {i: page(i, rng) for i in range(60)}
    rows = [(i, t) for i, (t, _) in made.items()] + [(0, made[0][0]), (900, None), (901, ""), (902, "  \n \n"), (None, "A line of its own that is long enough.")]
    df = spark.createDataFrame(rows, ARTICLE).selectExpr("*", "1 as line_no", "'x' as mark")
    got = {}
    for r in M.main_lines(df).collect():
        got.setdefault(r.article_id, set()).add(r.line_no)
    assert got == {i: own for i, (_, own) in made.items()}
    text = {r.article_id: r for r in M.main_text(df).collect()}
    assert text[1].n_kept == 12 and "Follow us" not in text[1].body and len(text) == 61
    assert M.main_lines(df.limit(0)).count() == 0


def scores(got, made):
    """Recall and precision of the found lines."""
    found, true = {(r.article_id, r.line_no) for r in got}, {(i, n) for i, (_, own) in made.items() for n in own}
    return len(found & true) / len(true), len(found & true) / max(1, len(found))


def test_the_ratio_decides(spark, monkeypatch):
    """With the threshold moved so that no place is dense nothing is found."""
    rng = random.Random(4)
    made = {i: page(i, rng) for i in range(60)}
    df = spark.createDataFrame([(i, t) for i, (t, _) in made.items()], ARTICLE)
    assert scores(M.main_lines(df).collect(), made) == (1, 1)
    monkeypatch.setattr(M, "two_clusters", lambda counts: 99.0)
    assert scores(M.main_lines(df).collect(), made)[0] < 0.9


def test_flat_ratios_lose_recurring_lines(spark, monkeypatch):
    """Without smoothing over neighbours no subheading is found."""
    rng = random.Random(4)
    made = {i: page(i, rng) for i in range(60)}
    monkeypatch.setattr(M, "smoothed", lambda ratio, sizes: (ratio, ratio, ratio))
    assert scores(M.main_lines(spark.createDataFrame([(i, t) for i, (t, _) in made.items()], ARTICLE)).collect(), made)[0] < 0.9


def test_markup_is_read_by_line():
    text, lines = M.lines_of("<p>One <b>bold</b> line.</p>\n<script>x</script>\nplain\n<a href='x'>A link of some length</a>", M._Known())
    assert text == ["One bold line.", "", "plain", "A link of some length"]
    assert [(no, ratio) for no, _, ratio, _ in lines] == [(1, 3.0), (3, 5.0), (4, 0.0)]
    assert M.lines_of("plain and simple.\n\nHome | Shop | Cart", M._Known())[1] == [(1, M.SENTENCE, 17.0, M._Known()["plain and simple."][2]), (3, M.CHAIN, 0.0, 0)]


def test_pages_with_markup(spark):
    menu = "<div><a href='/'>Home</a> <a href='/s'>Shop</a> <a href='/c'>Contact us</a></div>"
    rows = [(i, "\n".join([menu, menu, f"<p>The {chr(97 + i % 26)}{i} pump of this car was found dry, so it was changed.</p>", f"<p>After {i} days the second pump was dry as well.</p>", menu, menu])) for i in range(40)]
    got = {}
    for r in M.main_lines(spark.createDataFrame(rows, ARTICLE)).collect():
        got.setdefault(r.article_id, set()).add(r.line_no)
    assert got == {i: {3, 4} for i in range(40)}


ITEMS = {1: "Read the case. Suppose 66 cells at 3.2 volts feed lead D39-32 through the secondary encoder, losing 740 A every 57 seconds. Which single part explains 723 mA at K12-44 and what reading would prove you wrong?",
         2: "Read the case. Suppose 12 cells at 4.1 volts feed lead A11-90 through the secondary encoder, losing 99 A every 31 seconds. Which single part explains 15 mA at B77-10 and what reading would prove you wrong?"}


def test_leaks(spark):
    case = ITEMS[1][15:]
    words = case.split()
    noise = "the car was parked behind the mill and nobody looked at it for a week " * 3
    docs = [(1, noise + case.upper().replace(",", "") + noise), (2, noise + " ".join(words[:9]) + " " + noise), (3, noise + "\n> ".join(words[: len(words) // 2 + 4]) + " " + noise), (4, None), (5, ""), (6, "Read the case."),
            (7, noise + " ".join(w if k % 9 else "other" for k, w in enumerate(words)) + noise), (8, " ".join(words[:18]) + " " + noise + " " + " ".join(words[-18:])), (9, "word " * 50_000)]
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "5 as item_id")
    items = spark.createDataFrame(list(ITEMS.items()) + [(3, None), (4, "")], "item_id long, text string")
    got = sorted((r.doc_id, r.item_id) for r in L.leaks(df, items).collect())
    assert got == [(1, 1), (3, 1), (7, 1), (8, 1)]
    clean = {r.doc_id: r for r in L.without_leaks(df, items).collect()}
    assert len(clean) == 9 and "740" not in clean[1].text and clean[2].text == docs[1][1] and clean[4].text is None and clean[1].removed_words > 20
    assert L.leaks(df, items.limit(0)).count() == 0 and L.leaks(df.limit(0), items).count() == 0


DOC = "doc_id long, text string, lang string, source string, origin string, make string"


def docs(spark, rows):
    return spark.createDataFrame(rows, DOC)


def test_mixing(spark):
    rng = random.Random(1)
    rows = [(i, "the pump ran dry " * rng.randint(1, 9), rng.choice(["en", "EN", None, "de"]), rng.choice("aaaabbc"), None, rng.choice(["x", None])) for i in range(3000)]
    rows += [(9001, None, None, "a", None, None), (9002, "x", None, "other", None, None), (9003, "x", None, None, None, None)]
    targets = spark.createDataFrame([("a", 0.3, 1), ("b", 0.3, 2), ("c", 0.3, 2), ("d", 0.1, 4)], "source string, target_share double, max_repeats int")
    got = {r.source: r for r in X.shares(docs(spark, rows), targets).collect()}
    assert set(got) == set("abcd") and got["d"].short and got["d"].tokens == 0
    total = sum(r.tokens for r in got.values())
    for r in got.values():
        assert r.most_copies <= r.max_repeats and r.short == (r.tokens * r.max_repeats < r.target_share * total)
        want = min(r.tokens * r.max_repeats, r.target_share * total)
        assert abs(r.used - want) <= 0.08 * total * 0.3 + 20
    first, again = ({tuple(r) for r in X.mixture(docs(spark, rows), targets).collect()} for _ in range(2))
    assert first == again and len(first) == 3001
    empty = {r.source: r.short for r in X.shares(docs(spark, rows).limit(0), targets).collect()}
    assert empty == dict.fromkeys("abcd", True)


def test_rake_holds_margins():
    rng = np.random.default_rng(2)
    cells = pd.DataFrame([(s, g, t, int(rng.integers(50, 500))) for s in "abc" for g in "xy" for t in "pq"], columns=["source", "lang", "topic", "tokens"])
    targets = pd.DataFrame({"source": list("abc"), "target_share": [0.2, 0.3, 0.5], "max_repeats": [9, 9, 9]})
    got = X.rake(cells, targets)
    total = cells["tokens"].sum()
    used = got["weight"] * got["tokens"]
    assert np.allclose(used.groupby(got["source"]).sum(), np.array([0.2, 0.3, 0.5]) * total, rtol=1e-4)
    assert np.allclose(used.groupby(got["lang"]).sum(), cells.groupby("lang")["tokens"].sum(), rtol=1e-2)


VOCAB = {1: "rotor stator magnet winding", 2: "cable socket plug charger", 3: "court permit clause ruling"}


def sentence(rng, s):
    a, b = rng.sample(VOCAB[s].split(), 2)
    return f"{rng.choice(['We looked at', 'Nobody expected', 'It was about'])} the {a} and the {b} {rng.choice(['today', 'again', 'at last'])}."


def test_subjects(spark):
    rng = random.Random(7)
    rows, truth = [], {}
    exam = "Suppose the court permit of clause nine and the ruling of the long court case is known."
    for i in range(400):
        own = rng.sample([1, 2, 3], 1 if rng.random() < 0.7 else 2)
        parts = [sentence(rng, s) for s in own for _ in range(5)]
        if rng.random() < 0.3:
            parts.insert(2, exam)
        rng.shuffle(parts)
        rows.append((i, " ".join(parts), "en", "a", "o1", None))
        truth[i] = set(own)
    rows += [(900, None, None, None, None, None), (901, "", None, None, None, None), (902, "zzz yyy xxx www.", None, "a", None, None), (None, "x", None, None, None, None)]
    at = dt.datetime(2024, 1, 1)
    labels = spark.createDataFrame([(i, s, "ann", at) for i in range(200) for s in truth[i]] + [(5, 99, "ann", at), (77777, 1, "ann", at), (None, 1, "ann", at)], "doc_id long, subject_id int, annotator string, labelled_at timestamp")
    subjects = spark.createDataFrame([(1, "a", None), (2, "b", None), (3, "c", None)], "subject_id int, subject string, description string")
    items = spark.createDataFrame([(1, exam)], "item_id long, text string")
    df = docs(spark, rows + rows[:5])
    got = {}
    for r in S.document_subjects(df, labels, subjects, items).collect():
        got.setdefault(r.doc_id, []).append(r.subject_id)
    assert set(got) == set(truth) | {900, 901, 902} and all(1 <= len(v) <= 2 for v in got.values())
    right = np.mean([set(got[i]) == truth[i] for i in range(200, 400)])  # held-out documents
    assert right >= 0.97
    assert S.document_subjects(df, labels.limit(0), subjects, items).count() == 0
    assert S.document_subjects(df.limit(0), labels, subjects, items).count() == 0


def test_subjects_of_the_labelled_sample(spark):
    """Labels of the test data held out by halves; a few of them are wrong."""
    from faultlake.session import table

    sf = "/root/testdata/sf0.1"
    labels = table(spark, sf, "subject_labels")
    got = S.document_subjects(table(spark, sf, "documents"), labels.where("doc_id % 4 > 0 and doc_id % 8 <> 6"), table(spark, sf, "subjects"), table(spark, sf, "eval_items")).toPandas()
    held = labels.where("doc_id % 8 = 6 or doc_id % 4 = 0").toPandas().groupby("doc_id").subject_id.apply(set)
    mine = got.groupby("doc_id").subject_id.apply(set)
    assert np.mean([mine[d] == s for d, s in held.items()]) >= 0.9


def sentences(texts, exam):
    ids = S.Ids()
    grams = S.windows(np.array([ids.add(w) for w in exam.split()]))
    found = S.Texts(texts, ids, np.sort(grams), len(ids))
    ends = np.cumsum(found.lengths)
    return [(int(found.documents[k]), found.words[ends[k] - found.lengths[k]:ends[k]]) for k in np.flatnonzero(found.own)]


def test_exam_windows():
    exam = "one two three four five six seven"
    got = sentences(["Before it all began. ONE two three, four five six seven. After it all ended.", None, "Too short.", "", "Own words here."], exam)
    assert got == [(0, ["before", "it", "all", "began"]), (0, ["after", "it", "all", "ended"]), (4, ["own", "words", "here"])]
    # a few changed words between two windows belong to the passage, a long stretch does not
    assert sentences(["one two three four five x y six seven z. One two three four five."], exam) == []
    assert len(sentences(["one two three four five. " + "own words of the text. " * 4 + "three four five six seven."], exam)) == 4


def random_votes(rng, n, accuracy, k=3):
    truth = rng.integers(0, k, n)
    votes = np.stack([np.where(rng.random(n) < a, truth, rng.integers(0, k, n)) for a in accuracy], axis=1)
    votes[rng.random(votes.shape) < 0.2] = -1
    return truth, votes


def test_the_latent_model_learns_accuracies():
    rng = np.random.default_rng(5)
    truth, votes = random_votes(rng, 20_000, (0.9, 0.8, 0.6, 0.3, 0.0))
    kinds, n = np.unique(votes, axis=0, return_counts=True)
    latent = S.Latent(3)
    latent.learn(kinds, n.astype(float))
    assert np.allclose(latent.alpha, (0.9, 0.8, 0.6, 0.3, 0.0), atol=0.06)
    learned = (latent.posterior(votes).argmax(axis=1) == truth).mean()
    assert learned > 0.92 and learned > (S.Latent(3).posterior(votes).argmax(axis=1) == truth).mean()


def test_the_latent_model_decides(spark, monkeypatch):
    """Without its accuracies the posterior is the prior, and the subjects are lost."""
    rng = random.Random(7)
    rows, labels = [], []
    for i in range(200):
        own = rng.choice([1, 2, 3])
        rows.append((i, " ".join(sentence(rng, own) for _ in range(5)), "en", "a", "o", None))
        labels.append((i, own, "ann", dt.datetime(2024, 1, 1)))
    frames = (docs(spark, rows), spark.createDataFrame(labels[:100], "doc_id long, subject_id int, annotator string, labelled_at timestamp"),
              spark.createDataFrame([(k, str(k), None) for k in (1, 2, 3)], "subject_id int, subject string, description string"), spark.createDataFrame([(1, "x")], "item_id long, text string"))

    def recall():
        got = {(r.doc_id, r.subject_id) for r in S.document_subjects(*frames).collect()}
        return np.mean([(i, s) in got for i, s, *_ in labels[100:]])

    assert recall() >= 0.97
    monkeypatch.setattr(S.Latent, "learn", lambda self, votes, n, rounds=50: setattr(self, "alpha", np.zeros(len(S.FUNCTIONS))))
    assert recall() < 0.9


def test_too_many_entries(spark, monkeypatch):
    from faultlake.llm import canonical

    monkeypatch.setattr(canonical, "MAX_ENTRIES", 1)
    entries = spark.createDataFrame([(1, "a", "b"), (2, "a", "c")], "model_id int, make string, model string")
    with pytest.raises(ValueError):
        canonical.manual_models(spark.createDataFrame([("d", ("a", "b"))], "document_id string, vehicle struct<make:string,model:string>"), entries)
