"""The registered text queries on the whole small tables: SQL, brute force, or what their results must agree on."""

import re
from collections import Counter, defaultdict

import pyarrow.parquet as pq
import pytest

from faultlake.llm import leaks, plans, split
from oracle import DATA, compare


def rows(name):
    return pq.read_table(f"{DATA}/{name}.parquet").to_pylist()


def once(name, key):
    return list({r[key]: r for r in rows(name) if r[key] is not None}.values())


@pytest.fixture(scope="module")
def results(spark):
    found = {}

    def get(name):
        if name not in found:
            found[name] = [r.asDict() for r in plans.QUERIES[name](spark, DATA).collect()]
        return found[name]
    return get


@pytest.mark.parametrize("name", sorted(plans.SQL))
def test_sql(spark, name):
    compare(spark, name, plans.QUERIES[name], plans.SQL[name])


def test_pieces(results):
    texts = {("dtc_records", r["record_id"], k): s["cleaned_text"] for r in once("dtc_records", "record_id") for k, s in enumerate(r["sections"] or [], 1) if s}
    texts |= {("code_records", r["record_id"], k): b["text"] for r in once("code_records", "record_id") for k, b in enumerate(r["content_blocks"] or [], 1) if b}
    long = {k: t for k, t in texts.items() if t and len(t) > 1500}
    pieces = defaultdict(list)
    for r in results("p1_pieces"):
        pieces[r["item_table"], r["record_id"], r["item_pos"]].append((r["piece_no"], r["start_char"], r["end_char"], r["piece"]))
    assert set(pieces) == set(long) and long
    for key, own in pieces.items():
        own.sort()
        assert [n for n, *_ in own] == list(range(1, len(own) + 1)) and own[0][1] == 0 and own[-1][2] == len(long[key])
        assert all(long[key][a:b] == piece and len(piece) <= 1500 for _, a, b, piece in own)
        assert all(c <= b < d and b - c <= 150 for (_, _, b, _), (_, c, d, _) in zip(own, own[1:], strict=False))
        assert [(a, b) for _, a, b, _ in own] == split.spans(long[key])


def test_near_duplicates_against_all_pairs(results):
    sets = {}
    for r in once("code_records", "record_id"):
        text = " ".join(x for x in [r["title"], *(b["text"] for b in r["content_blocks"] or [] if b and b["block_type"] == "text")] if x is not None)
        w = re.findall(r"[^\W_]+", text.lower())
        if len(w) >= 3:
            sets[r["record_id"]] = {tuple(w[k:k + 3]) for k in range(len(w) - 2)}
    ids = sorted(sets)
    want = {(a, b) for i, a in enumerate(ids) for b in ids[i + 1:] if 2 * len(sets[a] & sets[b]) >= len(sets[a] | sets[b])}
    got = {(r["record_a"], r["record_b"]) for r in results("p3_found")}
    assert not got - want and len(want - got) <= 0.02 * len(want) and want
    classes = {r["record_id"]: r["class_id"] for r in results("p3_classes")}
    assert len(classes) == len(once("code_records", "record_id")) and all(classes[a] == classes[b] for a, b in got)
    assert len({c for c in classes.values()}) >= len(classes) - len(got)


def test_models(results):
    given = {r["document_id"]: r["vehicle"] for r in once("manuals", "document_id") if r["vehicle"] and (r["vehicle"]["make"] is not None or r["vehicle"]["model"] is not None)}
    found = {r["document_id"]: r["model_id"] for r in results("p4_found")}
    listed = {r["model_id"]: r for r in rows("vehicle_models")}
    assert set(found) == set(given) and len(results("p4_found")) == len(given) and set(found.values()) <= {0, *listed}
    for d, v in given.items():  # whoever writes an entry as it is listed means it
        same = [i for i, e in listed.items() if (e["make"], e["model"]) == (v["make"], v["model"])]
        assert not same or found[d] == same[0]
    none = Counter((given[d]["make"], given[d]["model"]) for d, i in found.items() if not i)
    assert Counter({(r["make"], r["model"]): r["n"] for r in results("p4_unmatched")}) == none


def test_bodies(results):
    arts = {r["article_id"]: r["content"] for r in once("articles", "article_id") if r["content"]}
    lines = defaultdict(list)
    for r in results("p6_found"):
        lines[r["article_id"]].append(r["line_no"])
    assert set(lines) <= set(arts) and all(len(v) == len(set(v)) for v in lines.values())
    assert {r["article_id"] for r in results("p6_body")} == set(arts)
    for r in results("p6_body"):
        text = [x.strip() for x in arts[r["article_id"]].split("\n")]
        own = sorted(lines[r["article_id"]])
        assert r["body"] == "\n".join(text[i - 1] for i in own) and r["n_kept"] == len(own) and r["n_lines"] == sum(map(bool, text)) and all(text[i - 1] for i in own)
    codes = re.compile(r"[-•*–· ]*(?:[PBCU][0-9A-F]{4}\b|[A-Z]\d{4,9}-[A-Z]$)")
    for i, content in arts.items():  # list entries with a code are never the frame's
        assert {k for k, x in enumerate(content.split("\n"), 1) if codes.match(x.strip())} <= set(lines[i])


def test_leaks(results):
    docs, items = {r["doc_id"]: r["text"] for r in rows("documents")}, {r["item_id"]: r["text"] for r in rows("eval_items")}
    found = {(r["doc_id"], r["item_id"]) for r in results("p7_found")}
    words = {i: set(leaks.words(t)) for i, t in items.items()}
    for d, i in found:
        own = set(leaks.words(docs[d]))
        numbers = {w for w in words[i] if any(c.isdigit() for c in w)}
        assert numbers & own and len(words[i] & own) >= 0.4 * len(words[i])
    shingles = lambda w: {tuple(w[k:k + 12]) for k in range(len(w) - 11)}
    first = Counter(s for t in items.values() for s in set(re.split(r"(?<=[.?!])\s+", t.strip())))
    case = {i: leaks.words(" ".join(s for s in re.split(r"(?<=[.?!])\s+", t.strip()) if first[s] == 1)) for i, t in items.items()}
    own = {i: shingles(w) for i, w in case.items()}
    for d, t in docs.items():  # whole verbatim copies cannot be missed
        w = shingles(leaks.words(t))
        assert all((d, i) in found for i, s in own.items() if s and len(s & w) >= 0.5 * len(s))
    assert {r["item_id"]: r["n_documents"] for r in results("p7_items")} == Counter(i for _, i in found)
    clean = {r["doc_id"]: r for r in results("p7_clean")}
    assert set(clean) == set(docs)
    for d, r in clean.items():
        assert (r["removed_words"] > 0) == (d in {x for x, _ in found}) and (r["removed_words"] > 0 or r["text"] == docs[d])
        assert r["removed_words"] == len(leaks.words(docs[d])) - len(leaks.words(r["text"]))


def test_mixture(results):
    targets, docs = {r["source"]: r for r in rows("mix_targets")}, {r["doc_id"]: r for r in rows("documents")}
    mixed = results("p8_mixture")
    assert {r["doc_id"] for r in mixed} == {d for d, r in docs.items() if r["source"] in targets}
    assert all(0 <= r["copies"] <= targets[r["source"]]["max_repeats"] for r in mixed)
    tokens, used = Counter(), Counter()
    for r in mixed:
        tokens[r["source"]] += r["n_tokens"]
        used[r["source"]] += r["n_tokens"] * r["copies"]
    shares = {r["source"]: r for r in results("p8_shares")}
    short = {s for s, t in targets.items() if tokens[s] * t["max_repeats"] < t["target_share"] * sum(tokens.values())}
    assert set(shares) == set(targets) and {r["source"] for r in results("p8_found")} == short
    for s, r in shares.items():
        assert (r["tokens"], r["used"]) == (tokens[s], used[s]) and abs(r["actual_share"] - used[s] / sum(used.values())) < 1e-9


def test_subjects(results):
    docs, names = {r["doc_id"]: r for r in rows("documents")}, {r["subject_id"]: r["subject"] for r in rows("subjects")}
    own = defaultdict(set)
    for r in results("p9_found"):
        own[r["doc_id"]].add(r["subject_id"])
    assert set(own) == set(docs) and all(1 <= len(s) <= 2 and s <= set(names) for s in own.values()) and len(results("p9_found")) == sum(map(len, own.values()))
    part = Counter()
    for s in own.values():
        for x in s:
            part[names[x]] += 1 / len(s)
    assert {r["subject"]: round(r["n_documents"], 6) for r in results("p9_composition")} == {k: round(v, 6) for k, v in part.items()}
