"""Lexical search, transducers and the divergence audit against brute force."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from ledgerline.llm import divergence, lexical_search, scan
from ledgerline.llm.transducer import Transducer
from tests.llm.test_documents import low

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LETTERS = re.compile(r"[^\x00-\x60\x7B-\x7F]+")


# ---- pieces of long texts


def test_pieces_divide_no_word():
    rng = random.Random(1)
    for _ in range(200):
        body = "".join(rng.choice(["a", "É", " ", "\n", "word", "9"]) for _ in range(rng.randint(0, 60))).encode()
        for letters, pattern in ((scan.WORD_BYTES, lexical_search.TERM), (scan.LETTER_BYTES, divergence.TERM)):
            cut = list(scan.pieces(body, letters, rng.randint(1, 9)))
            assert b"".join(cut) == body
            assert [w for p in cut for w in pattern.findall(p)] == pattern.findall(body)


# ---- search


def best_by_hand(docs, items, k):
    """``docs``: id, text; ``items``: texts. For each item ``(score, id)`` of the best."""
    counts = [(d, Counter(WORD.findall(low(t or "")))) for d, t in docs]
    counts = [(d, c) for d, c in counts if c]
    total = sum(c.total() for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    found = []
    for item in items:
        scores = []
        for d, c in counts:
            m = 100 - 25 + (25 * c.total() * len(counts)) // total
            score = sum(q * math.floor(1000 * math.log((2 * len(counts) + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * c[t]) // (1000 * c[t] + 12 * m)) for t, q in Counter(WORD.findall(low(item or ""))).items() if c[t])
            if score > 0:
                scores.append((score, d))
        found.append(sorted(scores, key=lambda x: (-x[0], x[1] is None, x[1] or 0))[:k])
    return found


def corpus(rng, n, vocabulary=300):
    """Documents of a few topics, with copies and cases of every kind."""
    words = [f"w{k}" for k in range(vocabulary)] + ["É", "ünd"]
    topics = [rng.sample(words, 40) for _ in range(6)]
    texts = [" ".join(rng.choice(rng.choice(topics) if rng.random() < 0.1 else topics[k % 6]) for _ in range(rng.randint(1, 60))) for k in range(n)]
    texts += [texts[0]] * 30 + [None, "", "--", "W1 w1, W1!", "É " * 3000, "w2 " * 200_000]
    return [(k if k % 11 else None, t) for k, t in enumerate(texts)], [" ".join(rng.sample(rng.choice(topics), 12)) + " w1 w1" for _ in range(12)] + [texts[0], "unknown", "", None, texts[3], texts[3], "w2"]


@pytest.mark.parametrize("chunk_terms", [4_096, 30])
def test_search_equals_brute_force(spark, monkeypatch, chunk_terms):
    monkeypatch.setattr(lexical_search, "CHUNK_TERMS", chunk_terms)
    monkeypatch.setattr(lexical_search, "VOCABULARY", 200_000 if chunk_terms > 30 else 100)
    docs, items = corpus(random.Random(2), 400)
    df = spark.createDataFrame([(d, t, 1, "r") for d, t in docs], "doc_id long, text string, score int, rank string")
    asked = spark.createDataFrame([(k, t, 0) for k, t in enumerate(items)], "item_id int, text string, nr int")
    found = defaultdict(list)
    for r in lexical_search.ranked(df, asked, k=7).orderBy("item", "rank").collect():
        found[r.item].append((r.score, r.id, r.rank))
    for k, expected in enumerate(best_by_hand(docs, items, 7)):
        assert [x[:2] for x in found[k]] == expected
        assert [x[2] for x in found[k]] == list(range(1, len(expected) + 1))


def test_search_of_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    items = spark.createDataFrame([("x", "b c")], "item_id string, text string")
    assert lexical_search.ranked(docs.limit(0), items).count() == 0
    assert lexical_search.ranked(docs, items.limit(0)).count() == 0
    assert [tuple(r) for r in lexical_search.ranked(docs, items).collect()] == [("x", 1, 1, lexical_search.weight(1, 1) * (10**9 // (1000 + 1200)))]


def cell(rng, n_rows, n_terms, n_items):
    """Vectors around a few topics, items of one topic each."""
    topics = [rng.choice(n_terms, 25, replace=False) for _ in range(8)]
    rows, columns = [], []
    for r in range(n_rows):
        own = np.unique(np.concatenate([rng.choice(topics[r % 8], 12), rng.choice(n_terms, 3)]))
        rows.append(np.full(len(own), r))
        columns.append(own)
    rows, columns = np.concatenate(rows), np.concatenate(columns)
    df = np.bincount(columns, minlength=n_terms)
    weights = np.array([lexical_search.weight(n_rows, int(x)) for x in df], np.int64)
    rank = np.argsort(np.argsort(df, kind="stable"), kind="stable")
    items = []
    for k in range(n_items):
        own = np.array([t for t in rng.choice(topics[k % 8], 14, replace=False) if df[t]])
        items.append((k, own[np.argsort(rank[own])], rng.integers(1, 3, len(own))))
    return rows, columns, rng.integers(1, 1_000_000, len(rows)), weights, rank, items


@pytest.mark.parametrize("coordinates", [256, 5])
def test_blocks_are_skipped_and_bounds_hold(monkeypatch, coordinates):
    monkeypatch.setattr(lexical_search, "COORDINATES", coordinates)
    rng = np.random.default_rng(3)
    rows, terms, impacts, weights, rank, items = cell(rng, 1_500, 400, 24)
    chunk = lexical_search.Chunk(items, weights).prepare(rank)
    columns = chunk.columns_of(terms)
    assert (columns >= 0).sum() < len(columns)
    rows, columns, impacts = rows[columns >= 0], columns[columns >= 0], impacts[columns >= 0]
    made = lexical_search.blocks_of(chunk, rows, columns, impacts, 1_500)
    best = [lexical_search.Best(20) for _ in items]
    met, opened = lexical_search.search_cell(chunk, best, list(range(1_500)), rows, columns, impacts, *made)
    matrix = lexical_search.dense(rows, columns, impacts, (1_500, len(chunk.terms)))
    for own, (_, asked, often) in zip(best, chunk.asked):
        scores = matrix[:, asked].astype(np.int64) @ often
        assert own.rows == sorted(((int(s), d) for d, s in enumerate(scores) if s > 0), key=lambda x: (-x[0], x[1]))[:20]
    if coordinates == 256:
        assert opened < 0.6 * met
    first = np.concatenate(([0], np.cumsum(made[1])))
    at = 0
    for b, c in enumerate(made[0].tolist()):
        found, groups = chunk.coordinates(c)
        summary = made[3][at : at + len(groups)]
        at += len(groups)
        members = made[2][first[b] : first[b + 1]]
        assert len(members) <= lexical_search.BLOCK
        assert (np.maximum.reduceat(matrix[np.ix_(members, found)], groups, axis=1).max(0) == summary).all()


# ---- transducer


def test_transducer_is_minimal_and_ordered():
    rng = random.Random(4)
    terms = sorted({"".join(rng.choice("abé") for _ in range(rng.randint(1, 6))).encode() for _ in range(400)})
    made = Transducer.unpack(Transducer.build(terms).pack())
    assert list(made.terms()) == terms and len(made) == len(terms)
    others = [t + b"x" for t in terms[:50]] + [b"a" * 5000, "ß".encode(), b""]
    body = b" ".join(terms + others)
    ends = np.cumsum([len(t) + 1 for t in terms + others]) - 1
    starts = ends - [len(t) for t in terms + others]
    found = made.ordinals(np.frombuffer(body, np.uint8), starts, ends)
    assert found.tolist() == [*range(len(terms)), *[-1] * len(others)]
    # two states with the same way on would be one
    moves = [(bool(f), tuple(zip(made.labels[a:b].tolist(), made.targets[a:b].tolist()))) for f, a, b in zip(made.final, made.first, made.first[1:])]
    assert len(set(moves)) == len(moves)
    futures = lambda way: frozenset(t[len(way) :] for t in terms if t.startswith(way))
    assert len(moves) == len({futures(t[:k]) for t in terms for k in range(len(t) + 1)})


def test_transducer_needs_ascending_terms():
    for wrong in ([b"b", b"a"], [b"a", b"a"], [b""]):
        with pytest.raises(ValueError, match="ascending"):
            Transducer.build(wrong)


# ---- audit


def audit_by_hand(docs, least, top):
    docs = [(lang or "", source or "", LETTERS.findall(low(text or ""))) for text, lang, source in docs]
    held = Counter((lang, t) for lang, _, words in docs for t in set(words))
    kept = defaultdict(list)
    for (lang, t), n in held.items():
        if n >= least:
            kept[lang].append(t)
    counts = defaultdict(Counter)
    for lang, source, words in docs:
        for name in ((lang, source), (lang, None)):
            counts[name].update(w for w in words if w in set(kept[lang]))

    def p(lang, source, t):
        return 1 + (10**9 * (counts[lang, source][t] + 5)) // (counts[lang, source].total() + 5 * len(kept[lang]))

    rows = []
    for lang, source in {(lang, source) for lang, source, _ in docs}:
        others = {s for own, s, _ in docs if own == lang and s != source}
        far = sorted(((-sum(abs(p(lang, source, t) - p(lang, s, t)) for t in kept[lang]), s.encode()) for s in others))
        rows += [(lang, source, "pair", s.decode(), -v, k) for k, (v, s) in enumerate(far, 1)]
        marked = sorted((p(lang, None, t) - p(lang, source, t), t.encode()) for t in kept[lang] if counts[lang, source][t] and p(lang, source, t) > p(lang, None, t))
        rows += [(lang, source, "term", t.decode(), -v, k) for k, (v, t) in enumerate(marked[:top], 1)]
    return sorted(rows)


def audit_rows(rng):
    words = ["alpha", "Beta", "gamma9delta", "é", "ß", "über", "x", "zz", "ab", "abc", "rare"]
    docs = [(" ".join(rng.choice(words[: rng.randint(2, 10)]) for _ in range(rng.randint(0, 30))), rng.choice(["en", "en", "de", None]), rng.choice(["s1", "s2", "S3", "é", None])) for _ in range(150)]
    return docs + [(None, "fr", "s1"), ("", "fr", "s2"), ("alone", "it", "s1"), ("x " * 50_000, "en", "s1"), ("y" * 100_000, "en", "s2")] + [docs[0]] * 60


@pytest.mark.parametrize("small", [False, True])
def test_audit_equals_brute_force(spark, monkeypatch, small):
    rows = audit_rows(random.Random(5))
    docs = spark.createDataFrame([(*r, k, "p") for k, r in enumerate(rows)], "text string, lang string, source string, ordinal int, term string")
    if small:  # several passes over the texts and tiles of few sources
        monkeypatch.setattr(divergence, "LOADED", 1)
        monkeypatch.setattr(divergence, "TILE", 2)
    got = sorted(tuple(r) for r in divergence.Audit(docs, min_docs=8).report(top=3).collect())
    assert got == audit_by_hand(rows, 8, 3)


def test_transducers_of_a_large_vocabulary_are_ranges(spark):
    kept = spark.createDataFrame([("en", f"t{k:06d}".encode()) for k in range(divergence.SHARD + 10)] + [("de", b"x")], "lang string, term binary").coalesce(1)
    made = divergence.transducers(kept).orderBy("lang", "first").collect()
    assert sum(r.n for r in made) == divergence.SHARD + 11 and max(r.n for r in made) <= divergence.SHARD
    assert [t for r in made if r.lang == "en" for t in Transducer.unpack(bytes(r.packed)).terms()] == [f"t{k:06d}".encode() for k in range(divergence.SHARD + 10)]


def test_audit_of_an_empty_table(spark):
    docs = spark.createDataFrame([("a", "b", "c")], "text string, lang string, source string")
    assert divergence.Audit(docs.limit(0)).report().count() == 0
