"""The pipeline's stages against brute force, each on its own input."""

import importlib

import numpy as np
import public_tokenizers
import pytest

from fieldline.llm import quality
from fieldline.llm.common import read_table
from tests.llm.test_packing import check_packed
from tests.llm.test_simhash import brute as brute_groups
from tests.llm.test_substring import brute as brute_passages

pipeline = importlib.import_module("corpus_pipeline")
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    """Input and output rows of every stage, written and reread as the pipeline does."""
    docs, out = read_table(spark, SF, "documents"), {}
    base = tmp_path_factory.mktemp("pipeline")
    columns = docs.columns
    for name, stage in pipeline.STAGES:
        before = docs.collect()
        stage(spark, docs, SF).write.parquet(str(base / name))
        docs = spark.read.parquet(str(base / name))
        out[name] = (before, docs.collect())
        if name != "best_fit_packing":
            assert docs.columns == columns
    return out


def test_stage_names():
    assert [n for n, _ in pipeline.STAGES] == ["quality_classifier", "simhash_near_dedup", "substring_dedup", "target_mixing", "best_fit_packing"]


def test_quality_rejects_junk_only(spark, steps):
    before, after = steps["quality_classifier"]
    labels = {r.doc_id: r.quality for r in read_table(spark, SF, "labels").collect()}
    kept = {r.doc_id for r in after}
    assert kept <= {r.doc_id for r in before}
    good = [d in kept for d, q in labels.items() if q == 1]
    bad = [d in kept for d, q in labels.items() if q == 0]
    assert np.mean(good) > 0.97 and np.mean(bad) < 0.2
    model = quality.fit_quality(read_table(spark, SF, "documents"), read_table(spark, SF, "labels"))
    want = {r.doc_id for r in before if model.score(quality.encode(r.text), np.array([0]))[0] >= quality.THRESHOLD}
    assert kept == want


def test_one_document_of_each_group_stays(steps):
    before, after = steps["simhash_near_dedup"]
    want = sorted(d for d, _, best in brute_groups([(r.doc_id, r.text) for r in before]) if d == best)
    assert sorted(r.doc_id for r in after) == want
    assert {tuple(r) for r in after} <= {tuple(r) for r in before}


def test_passages_are_cut(steps):
    before, after = steps["substring_dedup"]
    assert {r.doc_id: r.text for r in after} == brute_passages([(r.doc_id, r.text) for r in before])
    assert all(r.n_chars == len(r.text) for r in after)


def test_mixing_keeps_clean_documents(spark, steps):
    before, after = steps["target_mixing"]
    toxic = {r.doc_id for r in read_table(spark, SF, "labels").collect() if r.toxic}
    kept = {r.doc_id for r in after}
    assert {tuple(r) for r in after} <= {tuple(r) for r in before} and len(after) == len(kept)
    assert np.mean([r.doc_id in kept for r in before if r.doc_id not in toxic]) > 0.95


def test_sequences_hold_all_documents(steps):
    from tokenizers import Tokenizer

    before, after = steps["best_fit_packing"]
    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    n, bound = check_packed(after, [(r.doc_id, r.text) for r in before], plain)
    assert n <= bound + 1


def test_run_applies_all_stages(spark, steps):
    got = pipeline.run(spark, SF)
    want = steps["best_fit_packing"][1]
    key = lambda r: (r.doc_id, r.piece, r.start, r.length, r.ids_crc32)
    assert sorted(map(key, got.collect())) == sorted(map(key, want))
