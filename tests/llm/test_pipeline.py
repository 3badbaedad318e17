"""The pipeline stage by stage against plain reckoning."""

import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from starloom.llm import queries

from cases import SCHEMA, case_rows
from test_jaccard import all_pairs
from test_packing import check_places, one_by_one
from test_rules import failed, verdicts_by_hand

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def results(spark, tmp_path_factory):
    """Rows before and after every stage."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    kept = [docs]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path_factory.mktemp("stages") / str(k))
        stage(spark, kept[-1], FOLDER).write.parquet(path)
        kept.append(spark.read.parquet(path))
    return kept


def test_stages_keep_the_columns(results):
    assert [name for name, _ in corpus_pipeline.STAGES][0] == "quality rules" and len(corpus_pipeline.STAGES) == 4
    assert all(df.dtypes == results[0].dtypes for df in results[:4])


def test_rules_stage(results):
    rows = results[0].collect()
    hosts = verdicts_by_hand([(r.source, failed(r.text)) for r in rows])
    want = [r for r in rows if not failed(r.text) and hosts[r.source]]
    assert Counter(results[1].collect()) == Counter(want) and len(want) < len(rows)


def test_classifier_stage(spark, results):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    before, after = results[1].collect(), {r.doc_id for r in results[2].collect()}
    assert set(results[2].collect()) <= set(before)
    right = [(r.doc_id in after) == bool(labels[r.doc_id]) for r in before if r.doc_id in labels]
    assert sum(right) / len(right) > 0.95


def test_near_duplicates_stage(results):
    rows = [(r.doc_id, r.text) for r in results[2].collect()]
    want = sorted({least for least, _ in all_pairs(rows)})
    assert sorted(r.doc_id for r in results[3].collect()) == want


def check_packing(docs, packed):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = Counter()
    for row in docs:
        ids = np.array(library.encode(row.text or "", add_special_tokens=False).ids + [0], "<u4")
        cuts = [0, *range(len(ids) % 2048 or 2048, len(ids) + 1, 2048)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want[row.doc_id, k, a, b - a, zlib.crc32(ids[a:b].tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in packed) == want
    sequences = check_places([(r.sequence_id, r.offset, r.length) for r in packed], 2048)
    assert sequences == one_by_one([r.length for r in packed], 2048)


def test_packing_stage(results):
    check_packing(results[3].collect(), results[4].collect())


def test_run_gives_the_last_stage(spark, results):
    got = Counter(corpus_pipeline.run(spark, FOLDER).collect())
    assert got == Counter(results[4].collect())
    assert corpus_pipeline.ORACLE_SQL is None and queries.QUERIES


def test_awkward_documents(spark):
    docs = spark.createDataFrame(case_rows(), SCHEMA)
    for _, stage in corpus_pipeline.STAGES:
        found = stage(spark, docs, FOLDER).collect()
        columns = defaultdict(int)
        for row in found:
            columns[tuple(row.asDict())] += 1
        assert len(columns) <= 1
    none = docs.limit(0)
    assert all(stage(spark, none, FOLDER).count() == 0 for _, stage in corpus_pipeline.STAGES)
