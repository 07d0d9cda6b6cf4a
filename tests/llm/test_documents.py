"""Line runs, decontamination, mixing and the Jaccard join on small hand-made tables."""

import hashlib
import itertools
import random
import re
from collections import Counter
from fractions import Fraction
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import decontaminate, jaccard_blocks, jaccard_join, line_runs, mixing, quality
from ledgerline.llm.components import components

WHITE = " \t\n\x0b\x0c\r"


def low(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


# ---- line runs


def kept_lines(texts, least):
    keys = [[low(x.strip(WHITE)) for x in (t or "").split("\n")] for t in texts]
    often = Counter(k for own in keys for k in set(own) if k)
    return [[x for x, k in zip((t or "").split("\n"), own) if not k or often[k] < least] for t, own in zip(texts, keys)]


def test_frequent_lines_go_in_every_document(spark):
    rng = random.Random(5)
    texts = ["\n".join(rng.choice(["Shared Line", " shared line\t", "É other", "", "x" * 5000, f"own {k}"]) for _ in range(rng.randint(0, 6))) for k in range(40)]
    texts += [None, "", "\n\n", "Shared Line"]
    docs = spark.createDataFrame([(k if k % 9 else None, t, "s", k) for k, t in enumerate(texts)], "doc_id long, text string, hash string, n_lines int")
    got = sorted((r.row.n_lines, r.n_lines, r.n_dropped, r.kept) for r in line_runs.dedup_lines(docs, min_docs=10).collect())
    expected = kept_lines(texts, 10)
    assert got == [(k, len((t or "").split("\n")), len((t or "").split("\n")) - len(e), None if t is None else "\n".join(e)) for k, (t, e) in enumerate(zip(texts, expected))]
    assert any(r[2] for r in got)


def batch_of(spark, *texts):
    return line_runs.document_lines(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))


def test_runs_are_compacted_by_level(spark):
    runs = line_runs.LineRuns(spark, min_docs=4, fanout=3)
    for k in range(10):
        runs.add(batch_of(spark, f"same\nown {k}\npair {k // 2}"))
    assert [len(level) for level in runs.levels] == [1, 0, 1]
    assert [len(level) for level in runs.frequent_levels] == [1, 0, 1]
    assert [bytes(r.hash) for r in runs.frequent().collect()] == [line_runs.line_hash(b"SAME ")]
    totals = Counter()
    for r in runs.counts().collect():
        totals[bytes(r.hash)] += r.docs
    assert totals == {line_runs.line_hash(f"own {k}".encode()): 1 for k in range(10)} | {line_runs.line_hash(f"pair {k}".encode()): 2 for k in range(5)}
    hashes = batch_of(spark, "same\nnew\nown 1").select(F.explode("hashes").alias("hash"))
    assert {bytes(r.hash) for r in runs.unseen(hashes).collect()} == {line_runs.line_hash(b"new"), line_runs.line_hash(b"own 1")}


def test_a_hash_counts_over_all_runs_until_it_is_frequent(spark):
    rng = random.Random(8)
    for fanout in (2, 5):
        runs, seen = line_runs.LineRuns(spark, min_docs=3, fanout=fanout), Counter()
        for _ in range(6):
            texts = ["\n".join(rng.choice("abcdefghijklmno") for _ in range(3)) for _ in range(2)]
            seen.update(x for t in texts for x in set(t.split("\n")))
            runs.add(batch_of(spark, *texts))
            assert {bytes(r.hash) for r in runs.frequent().collect()} == {line_runs.line_hash(x.encode()) for x, n in seen.items() if n >= 3}


def test_the_result_depends_on_the_anti_join(spark, monkeypatch):
    docs = spark.createDataFrame([(k, f"same\nown {k}") for k in range(60)], "doc_id long, text string")
    assert sorted(r.kept for r in line_runs.dedup_lines(docs, min_docs=3).collect()) == sorted(f"own {k}" for k in range(60))
    monkeypatch.setattr(line_runs.LineRuns, "unseen", lambda self, hashes: hashes)
    with pytest.raises(RuntimeError, match="anti-join"):
        line_runs.dedup_lines(docs, min_docs=3)


@pytest.mark.parametrize("most", [0, 1_000_000])
def test_hashes_to_drop_are_broadcast_only_if_few(spark, monkeypatch, most):
    monkeypatch.setattr(line_runs, "BROADCAST_HASHES", most)
    docs = spark.createDataFrame([(k if k % 5 else None, f"same\nown {k}") for k in range(40)], "doc_id long, text string")
    df = line_runs.dedup_lines(docs)
    assert sorted(r.kept for r in df.collect()) == sorted(f"own {k}" for k in range(40))
    assert ("ResolvedHint (strategy=broadcast)" in df._jdf.queryExecution().analyzed().toString()) == bool(most)


def test_no_documents(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, n_chars long")
    assert line_runs.without_frequent_lines(docs).collect() == []


# ---- decontamination


def word_list(text):
    out, word = [], ""
    for c in low(text or "") + " ":
        if c in "0123456789abcdefghijklmnopqrstuvwxyz" or ord(c) > 127:
            word += c
        elif word:
            out.append(word)
            word = ""
    return out


def plain_hits(text, items, n):
    words, hit, named = word_list(text), set(), set()
    for item, body in items:
        own = word_list(body)
        size = min(n, len(own))
        for s in range(len(own) - size + 1 if size else 0):
            for at in range(len(words) - size + 1):
                if words[at : at + size] == own[s : s + size]:
                    hit.update(range(at, at + size))
                    if item is not None:
                        named.add(str(item))
    return len(words), len(hit), sorted(named)


ITEMS = [(1, "One two-three four FIVE, six"), (20, "alpha beta"), (3, "Éa éb ec"), (4, None), (5, "..."), (6, "single"), (7, "one two three four nine"), (None, "alpha gamma")]
DOCS = [
    None,
    "",
    "!!!",
    "one TWO three four five six seven one two three four",
    "beta alpha beta alpha beta gamma",
    "Éa éb ec éa éb ec",
    "xx single yy single",
    "two three four five one two three " * 300,
    "alphabeta one two",
]


@pytest.mark.parametrize("broadcast", [10**6, 0])
def test_contamination_equals_brute_force(spark, broadcast):
    benchmark = spark.createDataFrame(ITEMS, "item_id long, text string")
    rows = [(k, t, "s") for k, t in enumerate(DOCS)] + [(3, DOCS[3], "again"), (3, DOCS[4], "other text"), (None, DOCS[6], None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, words string")
    got = Counter((r.id, r.n_words, r.n_hit, tuple(r["items"])) for r in decontaminate.contamination(docs, benchmark, n=4, broadcast_windows=broadcast).collect())
    expected = Counter((i, *plain_hits(t, ITEMS, 4)[:2], tuple(plain_hits(t, ITEMS, 4)[2])) for i, t, _ in rows)
    assert got == expected


def test_beyond_the_broadcast_no_text_is_sent_for_a_word(spark):
    long = " ".join(f"w{k}" for k in range(20_000))
    docs = spark.createDataFrame([(1, long), (2, "a b c w5 w6 w7 x"), (2, "a b c w5 w6 w7 x"), (None, "w5 w6 w7"), (3, None)], "doc_id long, text string")
    items = spark.createDataFrame([("i", "w5 w6 w7"), ("j", "w19999"), ("k", " ".join(f"w{k}" for k in range(100, 130)))], "item_id string, text string")
    windows = decontaminate.benchmark_windows(items, 10)
    few, many = (decontaminate.hits(docs, windows, broadcast_windows=n) for n in (10**6, 0))
    assert set(map(tuple, few.collect())) == set(map(tuple, many.collect())) and few.count() > 3
    lines = many._jdf.queryExecution().optimizedPlan().toString().split("\n")
    semi = [k for k, line in enumerate(lines) if "LeftSemi" in line]
    assert semi
    for k in semi:  # what is joined by a word's hash has no array of words
        depth = len(lines[k]) - len(lines[k].lstrip(" :+-"))
        left = next(line for line in lines[k + 1 :] if len(line) - len(line.lstrip(" :+-")) > depth)
        assert not re.search(r"[\[ ]words#\d+[,\]]", left)


def test_removing_documents_and_spans(spark):
    benchmark = spark.createDataFrame([(1, "one two three")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "A one, Two three! b", 3), (2, "clean one two", 4), (3, None, 5), (1, "clean", 6)], "doc_id long, text string, key int")
    assert sorted(r.key for r in decontaminate.remove_documents(docs, benchmark).collect()) == [4, 5, 6]
    spans = {r.key: r.text for r in decontaminate.remove_spans(docs, benchmark).collect()}
    assert spans == {3: "A ,  ! b", 4: "clean one two", 5: None, 6: "clean"}


def test_empty_benchmark(spark):
    docs = spark.createDataFrame([(1, "some words")], "doc_id long, text string")
    benchmark = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.remove_documents(docs, benchmark).count() == 1
    assert [r.n_hit for r in decontaminate.contamination(docs, benchmark).collect()] == [0]


# ---- mixing


def plain_targets(sizes, weights=(3, 1, 2), share=1.5, most=2.0):
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    budget, target, open_ = share * sum(sizes.values()), dict.fromkeys(sizes, 0.0), set(sizes)
    while budget > 1e-9 and open_:
        total, spare = sum(weight[s] for s in open_), 0.0
        for s in open_:
            target[s] += budget * weight[s] / total
        for s in list(open_):
            if target[s] >= most * sizes[s] - 1e-9:
                spare += target[s] - most * sizes[s]
                target[s] = most * sizes[s]
                open_.discard(s)
        budget = spare
    return target


def test_targets_and_copies(spark):
    rng = random.Random(4)
    rows = [(k, " ".join(["w"] * rng.choice([0, 1, 5, 40, 300])), rng.choice(["a", "b", "é", "z", None, "B"]) if k % 3 else "a") for k in range(900)]
    rows += [(5000 + k, None, "a") for k in range(5)] + [(7, "same text", "b")] * 4
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, source string, size int")
    sizes = Counter()
    for _, text, source in rows:
        sizes[source] += len((text or "").split())
    expected = plain_targets(dict(sizes))
    found = mixing.mix(docs, slot_rows=50).collect()
    assert len(found) == len(rows)
    taken = Counter()
    for r in found:
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(expected[r.source])
        assert 0 <= r.copies <= 2
        taken[r.source] += r.copies * r["size"]
    for source, target in expected.items():
        assert abs(taken[source] - target) <= 2 * 300
    assert sorted((r.id or -1, r["size"], r.copies) for r in found) == sorted((r.id or -1, r["size"], r.copies) for r in mixing.mix(docs.repartition(7), slot_rows=50).collect())
    emitted = mixing.emit(docs)
    assert emitted.columns == [*docs.columns, "copy"]
    copies = Counter(r.doc_id for r in emitted.collect())
    assert copies == Counter({r.id: 0 for r in []}) + sum((Counter({r.id: r.copies}) for r in mixing.mix(docs).collect()), Counter())


@pytest.mark.parametrize("rows", [[], [(1, None, None), (2, "", "a")]])
def test_mix_without_words(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = mixing.mix(docs).collect()
    assert len(found) == len(rows)
    assert all(r.target == 0 and r.copies * r["size"] == 0 for r in found)


# ---- Jaccard join


def plain_groups(rows, words, similarity):
    sets = []
    for _, text in rows:
        own = low(text or "").translate({ord(c): " " for c in WHITE}).split(" ")
        own = [w for w in own if w]
        size = min(words, len(own))
        sets.append({tuple(own[k : k + size]) for k in range(len(own) - size + 1)} if own else set())
    group = list(range(len(rows)))
    for a, b in itertools.combinations(range(len(rows)), 2):
        shared = len(sets[a] & sets[b])
        if sets[a] and sets[b] and shared >= similarity * (len(sets[a]) + len(sets[b]) - shared):
            old, new = group[b], group[a]
            group = [new if g == old else g for g in group]
    least = {}
    for g, (i, _) in zip(group, rows):
        least[g] = min(least.get(g, i), i)
    return Counter((i, len(s), least[g] if s else i) for g, s, (i, _) in zip(group, sets, rows))


def near_copies(rng, base, edits):
    words = base.split()
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return " ".join(words)


@pytest.mark.parametrize(("words", "similarity"), [(3, Fraction(9, 10)), (5, Fraction(4, 5)), (1, Fraction(1, 2))])
def test_groups_equal_brute_force(spark, words, similarity, monkeypatch):
    monkeypatch.setattr(jaccard_join, "PAIRS", 20)
    monkeypatch.setattr(jaccard_join, "BLOCK", 16)
    monkeypatch.setattr(jaccard_join, "SHINGLES", 500)
    monkeypatch.setattr(jaccard_join, "COMMON", 4)
    rng = random.Random(words)
    vocabulary = [f"w{k}" for k in range(60)]
    bases = [" ".join(rng.choice(vocabulary) for _ in range(rng.choice([4, 30, 120]))) for _ in range(8)]
    texts = [near_copies(rng, bases[0], rng.randint(0, 6)) for _ in range(70)]
    texts += [near_copies(rng, rng.choice(bases), rng.randint(0, 4)) for _ in range(80)]
    texts += [bases[1]] * 10 + [bases[1].upper(), None, "", " \t", "one", "ONE", "one two", "É é", "é é", "x " * 3000]
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    docs = spark.createDataFrame([(i, t, "n", 1) for i, t in rows], "doc_id long, text string, component string, n int")
    found = jaccard_join.near_duplicates(docs, words, similarity)
    assert Counter((r.id, r.n, r.component) for r in found.collect()) == plain_groups(rows, words, similarity)
    left = jaccard_join.keep_one(docs, words, similarity)
    assert left.columns == docs.columns
    assert sorted(r.doc_id for r in left.collect()) == sorted(i for i, _, c in plain_groups(rows, words, similarity) if i == c)


def test_rows_without_id_stay(spark):
    docs = spark.createDataFrame([(None, "a b c d e f"), (4, "a b c d e f"), (9, "a b c d e f"), (None, None)], "doc_id long, text string")
    assert sorted((r.doc_id or 0) for r in jaccard_join.keep_one(docs).collect()) == [0, 0, 4]
    assert jaccard_join.keep_one(docs.limit(0)).count() == 0


def test_metric_pairs_lose_nothing(monkeypatch):
    monkeypatch.setattr(jaccard_join, "AT_ONCE", 64)
    rng = np.random.default_rng(3)
    points = np.vstack([rng.integers(0, 4, (150, 8)), rng.integers(10, 14, (150, 8))]).astype(np.int16)
    index = np.arange(300)
    found = Counter((int(x), int(y)) for a, b in jaccard_join.metric_pairs(index, index, points, 5) for x, y in zip(a, b))
    apart = np.abs(points[:, None].astype(int) - points[None]).sum(2)
    assert set(found) == {(int(x), int(y)) for x, y in zip(*np.nonzero(apart <= 5))}
    assert max(found.values()) == 1


def test_division_loses_nothing(monkeypatch):
    monkeypatch.setattr(jaccard_blocks, "AT_ONCE", 64)
    rng = np.random.default_rng(3)
    own = [np.unique(rng.integers(100 * (k % 4), 100 * (k % 4) + 30, rng.integers(1, 60))).astype(np.uint64) for k in range(200)] + [np.zeros(0, np.uint64)]
    sets, index = jaccard_blocks.Sets(own), np.arange(201)
    plain = [[len(np.intersect1d(x, y)) for y in own] for x in own]
    for sparse, columns in ((64, 7), (0, 7), (10**9, 7)):
        monkeypatch.setattr(jaccard_blocks, "SPARSE", sparse)
        monkeypatch.setattr(jaccard_blocks, "COLUMNS", columns)
        assert sets.shared(index, index).tolist() == plain
    met = Counter((int(x), int(y)) for a, b in jaccard_blocks.parts_within(sets, index, index, 0.2) for x in a for y in b)
    near = {(x, y) for x in range(201) for y in range(201) if plain[x][y] and plain[x][y] >= 0.8 * (len(own[x]) + len(own[y]) - plain[x][y])}
    assert near <= set(met) and max(met.values()) == 1 and len(met) < 201 * 201


def test_forest_connects_what_pairs_connect():
    rng = np.random.default_rng(5)
    for _ in range(30):
        own = [np.unique(rng.integers(0, 25, 14)).astype(np.uint64) for _ in range(40)]
        part, minor = rng.integers(0, 25, 40), rng.random(40) < 0.7
        left, right = (np.arange(40), np.arange(40)) if rng.random() < 0.5 else (np.arange(20), np.arange(20, 40))
        links = jaccard_blocks.forest(jaccard_blocks.Sets(own), part, minor, left, right, Fraction(7, 10))
        similar = lambda x, y: 10 * len(np.intersect1d(own[x], own[y])) >= 7 * len(np.union1d(own[x], own[y]))  # noqa: B023, E731
        groups = {}
        for source in (links, [(x, y) for x in left for y in right if part[x] != part[y] and (minor[x] or minor[y]) and similar(x, y)]):
            group = {int(p): int(p) for p in part}
            for x, y in source:
                old, new = group[int(part[x])], group[int(part[y])]
                group = {k: new if g == old else g for k, g in group.items()}
            groups[len(groups)] = {frozenset(k for k in group if group[k] == g) for g in group.values()}
        assert groups[0] == groups[1]
        assert all(similar(x, y) for x, y in links)
        assert len(links) == len(set(part.tolist())) - len(groups[0])


def test_a_large_group_leaves_its_tasks_in_proportion(spark, monkeypatch):
    """Twice the near copies give about twice the rows in every written table, not four times."""
    rng = random.Random(7)
    base = " ".join(f"w{rng.randrange(4000)}" for _ in range(200))
    texts = [near_copies(rng, base, 2) for _ in range(1200)]
    monkeypatch.setattr(jaccard_join, "BLOCK", 256)
    rows = []
    for n in (300, 600, 1200):
        join = jaccard_join.JaccardJoin(spark.createDataFrame(list(enumerate(texts[:n])), "doc_id long, text string"), 3, Fraction(9, 10))
        got = Counter((r.id, r.n, r.component) for r in join.groups().collect())
        if n == 300:
            assert got == plain_groups(list(enumerate(texts[:n])), 3, Fraction(9, 10))
        rows.append({p.name.split("-", 1)[1]: spark.read.parquet(str(p)).count() for p in Path(join.folder).iterdir()})
    for less, more in zip(rows, rows[1:]):
        for name in ("home-possible", "home-links", "rest-pairs", "rest-links", "crossed-possible", "crossed-links", "links"):
            assert more.get(name, 0) <= 3 * max(less.get(name, 0), 300), (name, less, more)


def test_word_hashes_follow_words():
    assert list(jaccard_join.word_hashes(b"a B  a\tb\n")) == list(jaccard_join.word_hashes(b"A b A B"))
    assert len(set(jaccard_join.word_hashes(b"ab ba abb a b aab \xc3\xa9 \xc3\x89"))) == 8


def test_components_of_chains_and_stars(spark):
    links = [(k, k + 1) for k in range(100, 160)] + [(7, k) for k in range(1000, 1100)] + [(500, 501), (501, 500), (5, 5)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert all(got[k] == 100 for k in range(100, 161))
    assert all(got[k] == 7 for k in [7, *range(1000, 1100)])
    assert (got[500], got[501]) == (500, 500)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_digest_of_kept_text_is_of_utf8(spark):
    docs = spark.createDataFrame([(1, "é\nü")], "doc_id long, text string")
    row = line_runs.dedup_lines(docs).select(F.sha2(F.col("kept").cast("binary"), 256).alias("h")).first()
    assert row.h == hashlib.sha256("é\nü".encode()).hexdigest()


def limited(made, most=1_000):
    """The same function over batches, which fails for a larger one."""

    def checked(batches):
        def each():
            for batch in batches:
                assert batch.num_rows <= most, batch.num_rows
                yield batch

        return made(each())

    return checked


def test_texts_go_to_python_in_small_batches(spark, monkeypatch):
    docs = spark.range(0, 2500, 1, 1).select(F.col("id").cast("string").alias("doc_id"), F.concat(F.lit("one two three four five six "), F.col("id").cast("string")).alias("text"))
    described, found = jaccard_join._described, quality._described
    monkeypatch.setattr(jaccard_join, "_described", lambda *a: limited(described(*a)))
    monkeypatch.setattr(quality, "_described", limited(found))
    monkeypatch.setattr(line_runs, "_hashed", limited(line_runs._hashed))
    assert jaccard_join.near_duplicates(docs).count() == 2500
    assert line_runs.dedup_lines(docs, batches=1).count() == 2500
    labels = docs.select("doc_id", F.lit(1).alias("quality"))
    assert quality.scores(docs, labels).count() == 2500


def test_low_documents_go_and_all_others_stay_as_they_are(spark, monkeypatch):
    rows = [("a", "good one", 1), ("a", "bad", 2), (None, "bad", 3), (None, "good two", 4), ("b", None, 5), ("c", "bad", 6), ("c", "bad", 7)]
    docs = spark.createDataFrame(rows, "doc_id string, text string, `row` int")

    def scores(documents, labels, keep, doc, text):
        return documents.select(F.struct(*keep).alias("row"), F.when(F.col(text) == "bad", 0.1).otherwise(0.9).alias("score"))

    monkeypatch.setattr(quality, "scores", scores)
    labels = spark.createDataFrame([("a", 1)], "doc_id string, quality int")
    for most in (1_000_000, 0):
        monkeypatch.setattr(quality, "BROADCAST_ROWS", most)
        kept = quality.without_low(docs, labels)
        assert kept.columns == docs.columns and sorted(r["row"] for r in kept.collect()) == [1, 4, 5]


def test_shared_shingles_are_counted_in_steps(monkeypatch):
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 60, 25)).astype(np.uint64) for _ in range(12)] + [np.zeros(0, np.uint64)]
    expected = [[len(np.intersect1d(x, y)) for y in sets] for x in sets]
    every = np.arange(len(sets))
    for sparse, listed in ((16, 1 << 20), (1 << 20, 1 << 21), (4, 8), (0, 1 << 20)):
        monkeypatch.setattr(jaccard_blocks, "SPARSE", sparse)
        monkeypatch.setattr(jaccard_blocks, "LISTED", listed)
        assert jaccard_blocks.Sets(sets).shared(every, every).tolist() == expected
    assert jaccard_blocks.Sets([]).shared(every[:0], every[:0]).shape == (0, 0)
