"""Executors have the tokenizer libraries, numpy and pyarrow, but not this package."""

import subprocess
import sys
from pathlib import Path

SCRIPT = """
import sys
sys.path.insert(0, {repo!r})
from pyspark.sql import SparkSession

spark = (
    SparkSession.builder.master("local[2]")
    .config("spark.ui.enabled", "false")
    .config("spark.sql.shuffle.partitions", "2")
    .getOrCreate()
)
import public_tokenizers
from pyspark.sql import functions as F
from starloom.llm import hard_negatives, html_extraction, phrase_mining, quality_classifier, queries, secret_scan, stages, token_counts

docs = spark.createDataFrame(
    [(k, "some words that are said here in text number %d of all" % (k // 2), "h") for k in range(12)],
    "doc_id bigint, text string, source string",
)
model = quality_classifier.train_classifier(docs.selectExpr("*", "doc_id % 2 AS label"))
counts = token_counts.count_tokens(docs, public_tokenizers.path("piece_bpe_32k.model")).count()
scored = quality_classifier.add_quality_score(docs, model).count()
kept = stages.keep_one_of_each(stages.keep_by_rules(docs)).count()
pages = spark.createDataFrame([(1, "<article><p>one</p></article>")], "page_id int, html string")
text = html_extraction.extract_main_text(pages, html_extraction.train_extractor(pages)).first().text
assert phrase_mining.mine_phrases(docs.withColumn("lang", F.lit("en")), least=4).count() > 0
vectors = spark.createDataFrame([(k, k % 2, [float(k % 5), 1.0]) for k in range(40)], "vec_id long, label int, embedding array<float>")
assert hard_negatives.mine_hard_negatives(vectors, F.col("vec_id") % 10 == 0).count() > 0
words = docs.withColumn("text", F.concat(F.col("text"), F.lit(" secondaryconsideration0 token = abcdef0123456789abcdef01 ")))
assert secret_scan.scan_secrets(words, secret_scan.train_scanner(words)).selectExpr("sum(size(spans)) AS n").first().n >= 24
print("found:", counts, scored, kept, queries.packed_documents(docs).count(), text)
"""


def test_python_tasks_need_no_package(tmp_path):
    repo = str(Path(__file__).resolve().parent.parent.parent)
    done = subprocess.run(
        [sys.executable, "-c", SCRIPT.format(repo=repo)], cwd=tmp_path, capture_output=True, text=True, timeout=600
    )
    assert "found: 12 12 6 12 one" in done.stdout, done.stderr[-2000:]
