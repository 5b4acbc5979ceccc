"""The pipeline over a small copy of the tables, stage by stage against
brute-force decisions on each stage's own input."""

import zlib

import numpy as np
import pytest

import corpus_pipeline as P
from flowlens.llm import packing, quality_rules, secret_scan, toxicity
from flowlens.llm.common import Memo, materialize

from .helpers import labels
from .test_ngram_join import brute as brute_classes

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def tables(spark, path):
    import random

    r = random.Random(11)
    vocabulary = [f"w{k}" for k in range(800)]
    rows, marks = [], []
    for k in range(700):
        words = r.choices(vocabulary, k=r.choice([30, 60, 120]))
        if k % 9 == 0:
            words[3] = words[11] = "vileword"
        if k % 10 == 1:
            words = [w + "###" for w in words]
        text = " ".join(words)
        if k % 13 == 2:
            text += f' token = "{zlib.crc32(text.encode()):08x}{zlib.crc32(text[::-1].encode()):08x}{k:08x}"'
        rows.append((k, text, "en", f"s{k % 3}", len(text)))
        marks.append((k, 0 if k % 10 == 1 else 1, int(k % 9 == 0)))
    for k in range(700, 760):       # exact and near copies
        text = rows[k - 700][1] if k % 2 else rows[k - 700][1] + " tail"
        rows.append((k, text, "en", "s0", len(text)))
    rows += [(760, None, None, None, None), (761, "", "en", "s1", 0), (None, "no id but a few plain words more than ten of them here now", "en", "s1", 5), (5, rows[5][1], "en", "s2", rows[5][4])]
    spark.createDataFrame(rows, COLUMNS).write.parquet(f"{path}/documents.parquet")
    labels(spark, marks).write.parquet(f"{path}/labels.parquet")
    return str(path)


def as_rows(df):
    return sorted((tuple(r) for r in df.select("doc_id", "text", "lang", "source", "n_chars").collect()), key=str)


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    sf = tables(spark, tmp_path_factory.mktemp("pipeline"))
    docs = [spark.read.parquet(f"{sf}/documents.parquet")]
    for _, stage in P.STAGES:
        docs.append(materialize(stage(spark, docs[-1], sf)))
    return sf, docs


def test_columns_stay(stages):
    _, docs = stages
    for d in docs[1:-1]:
        assert d.columns == docs[0].columns and d.dtypes == docs[0].dtypes


def test_toxicity_stage(spark, stages):
    sf, docs = stages
    predicted = {(r.doc_id): r.predicted for r in toxicity.toxicity(docs[0], spark.read.parquet(f"{sf}/labels.parquet")).collect()}
    assert as_rows(docs[1]) == [r for r in as_rows(docs[0]) if not predicted[r[0]]]
    assert {r[0] for r in as_rows(docs[0])} - {r[0] for r in as_rows(docs[1])} >= {0, 9, 18, 27}


def test_quality_stage(spark, stages):
    sf, docs = stages
    verdict = {r.doc_id: r.kept for r in quality_rules.quality_rules(docs[1], spark.read.parquet(f"{sf}/labels.parquet")).collect()}
    assert as_rows(docs[2]) == [r for r in as_rows(docs[1]) if verdict[r[0]]]
    assert not any("###" in r[1] for r in as_rows(docs[2]))


def test_near_copy_stage(stages):
    _, docs = stages
    rows = as_rows(docs[2])
    classes = brute_classes([(r[0], r[1]) for r in rows], 5, 80)
    kept = as_rows(docs[3])
    assert sorted(str(r[0]) for r in kept) == sorted({str(c) for _, _, c in classes})
    assert len(kept) == len({r[0] for r in kept}) and set(kept) <= set(rows)


def test_secret_stage(stages):
    _, docs = stages
    before, after = as_rows(docs[3]), as_rows(docs[4])
    assert [r[0] for r in before] == [r[0] for r in after]
    for b, a in zip(before, after):
        assert not secret_scan.base_spans(a[1]) and a[4] == len(a[1])
        if not secret_scan.base_spans(b[1]):
            assert a[1] == b[1]
    assert any(secret_scan.base_spans(b[1]) for b in before)


def test_packing_stage(spark, stages):
    sf, docs = stages
    encoder = packing.PieceEncoder(packing.vocabulary_path())
    ids = {r[0]: np.frombuffer(encoder.batch([r[1] or ""])[0], "<u4").tolist() + [packing.END_ID] for r in as_rows(docs[4])}
    pieces = docs[5].collect()
    assert sum(p.length for p in pieces) == sum(map(len, ids.values()))
    for p in pieces:
        assert p.ids_crc32 == zlib.crc32(np.array(ids[p.doc_id][p.start:p.start + p.length], "<u4").tobytes())
    again = P.run(spark, sf).collect()
    assert sorted((str(p.doc_id), p.start, p.length, p.ids_crc32) for p in again) == sorted((str(p.doc_id), p.start, p.length, p.ids_crc32) for p in pieces)


def test_empty_tables(spark, tmp_path):
    spark.createDataFrame([], COLUMNS).write.parquet(f"{tmp_path}/documents.parquet")
    labels(spark, []).write.parquet(f"{tmp_path}/labels.parquet")
    assert P.run(spark, str(tmp_path)).collect() == []


def test_memo_only_caches():
    made = []
    memo = Memo(lambda w: made.append(w) or len(w), limit=2)
    assert [memo[w] for w in ("a", "bb", "a")] == [1, 2, 1] and made == ["a", "bb"]
    memo["ccc"]
    memo.trim()
    assert not memo


def test_labels_without_verdict_keep_the_corpus(spark, tmp_path):
    """Documents without any label: the classifier and the certified rules reject nothing."""
    words = [f"w{k}" for k in range(400)]
    rows = [(k, " ".join(words[(k * 7 + j * (k % 11 + 1)) % 400] + str(k) for j in range(30)), "en", "s", 1) for k in range(50)]
    spark.createDataFrame(rows, COLUMNS).write.parquet(f"{tmp_path}/documents.parquet")
    labels(spark, []).write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in P.STAGES[:-1]:
        docs = materialize(stage(spark, docs, str(tmp_path)))
        assert docs.count() == 50, name
    assert {r.doc_id for r in P.run(spark, str(tmp_path)).collect()} == set(range(50))
