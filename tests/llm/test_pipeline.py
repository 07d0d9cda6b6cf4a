"""The pipeline's stages, each over what its predecessor kept, against plain versions of the same decisions."""

import os
from collections import Counter
from fractions import Fraction

import pytest

import corpus_pipeline
from tests.llm.test_documents import kept_lines, plain_groups, plain_hits

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables not present")


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    out = [("documents", docs)]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF_DIR).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        out.append((name, docs))
    return out


def test_all_but_the_last_keep_the_columns(stages):
    for _, docs in stages[:-1]:
        assert docs.dtypes == stages[0][1].dtypes
    assert stages[-1][1].columns == [*stages[0][1].columns, "copy"]


def test_quality_keeps_good_documents(spark, stages):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    kept = {r.doc_id for r in stages[1][1].collect()}
    good = [i for i, q in labels.items() if q == 1]
    assert sum(i in kept for i in good) / len(good) >= 0.97


def test_lines_go(stages):
    before, after = stages[1][1].collect(), {r.doc_id: r for r in stages[2][1].collect()}
    expected = kept_lines([r.text for r in before], 10)
    assert len(after) == len(before)
    for row, lines in zip(before, expected):
        assert after[row.doc_id].text == "\n".join(lines)
        assert after[row.doc_id].n_chars == len("\n".join(lines))


def test_one_of_each_group_stays(stages):
    before = [(r.doc_id, r.text) for r in stages[2][1].collect()]
    expected = sorted(i for i, n, c in plain_groups(before, 5, Fraction(4, 5)) if i == c)
    assert sorted(r.doc_id for r in stages[3][1].collect()) == expected


def test_contaminated_documents_go(spark, stages):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    expected = sorted(r.doc_id for r in stages[3][1].collect() if not plain_hits(r.text, items, 10)[1])
    assert sorted(r.doc_id for r in stages[4][1].collect()) == expected


def test_run_gives_the_last_stage(spark, stages):
    assert Counter(r.doc_id for r in corpus_pipeline.run(spark, SF_DIR).collect()) == Counter(r.doc_id for r in stages[-1][1].collect())


ODD = "doc_id long, text string, source string, row string, score double, key string, copies int, id int, found string"


def odd_rows(spark):
    good = [r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").orderBy("doc_id").limit(60).collect()]
    texts = [*good, None, "", " \n\t", good[0], good[0], "word " * 60_000, *[f"{t}\nthe same last line" for t in good[:12]]]
    rows = [(k if k % 13 else None, t, None if k % 5 == 0 else f"s{k % 3}", "r", 0.5, "k", 1, 2, "f") for k, t in enumerate(texts)]
    return spark.createDataFrame([*rows, rows[3], rows[3]], ODD)


@pytest.mark.parametrize("name", [name for name, _ in corpus_pipeline.STAGES])
def test_stages_take_odd_tables(spark, name):
    stage, docs = dict(corpus_pipeline.STAGES)[name], odd_rows(spark)
    left = stage(spark, docs, SF_DIR)
    assert left.columns == [*docs.columns, *(["copy"] if name == "mix" else [])]
    rows = left.collect()
    before = Counter((r.doc_id, r.text) for r in docs.collect())
    if name == "line_dedup":
        assert Counter(r.doc_id for r in rows) == Counter(i for i, _ in before.elements())
        assert sum(r.text is None for r in rows) == 1 and not any(r.text and "the same last line" in r.text for r in rows)
    elif name != "mix":
        after = Counter((r.doc_id, r.text) for r in rows)
        assert all(after[k] in (0, n) for k, n in before.items())  # repeated rows are decided alike
    if name in ("near_duplicates", "decontamination"):
        assert after[next(k for k in before if k[1] is None)] and all(r.source in (None, "s0", "s1", "s2") for r in rows)
    assert stage(spark, docs.limit(0), SF_DIR).count() == 0
