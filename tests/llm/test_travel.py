"""Functions of the corpus operators run on workers that do not have the package."""

import os
import pickle
import subprocess
import sys
import tempfile

from pyspark import cloudpickle

from sparkweave.llm import arrow_text, cross_polytope, fill_middle, html_crf, language_id, mixing, ngram_join, quality_rff, toxicity
from sparkweave.operators import bucket_links

REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def away(code, *files):
    """Run code in a process that cannot import the package."""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    with tempfile.TemporaryDirectory(prefix="run-") as folder:
        return subprocess.run([sys.executable, "-c", code, *files], cwd=folder, env=env, capture_output=True, text=True, timeout=600)


def test_worker_functions_load_without_the_package(tmp_path):
    functions = [
        arrow_text.each_words, arrow_text.word_counts, bucket_links.sketches_near(85), bucket_links._group_edges, cross_polytope.Polytopes, cross_polytope._best_of_group,
        fill_middle.BoundarySet, html_crf.main_text, html_crf.features, ngram_join.shingle_sets, ngram_join.signatures, quality_rff.statistics, toxicity.buckets,
    ]
    path = tmp_path / "functions"
    path.write_bytes(cloudpickle.dumps(functions))
    got = away("import pickle, sys; print(len(pickle.load(open(sys.argv[1], 'rb')))); print(any(m.startswith('sparkweave') for m in sys.modules))", str(path))
    assert got.stdout.split() == [str(len(functions)), "False"], got.stderr[-2000:]
    assert pickle and language_id and mixing


def test_operators_run_in_a_session_of_a_process_elsewhere():
    """A driver that added the repository by hand; its workers start in another folder without it on their path."""
    code = f"""
import sys, tempfile
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local-cluster[1,2,1024]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="run-")).getOrCreate()
spark.sparkContext.setLogLevel("OFF")
sys.path.insert(0, {REPO!r})
from sparkweave.llm import fill_middle, ngram_join, quality_rff, toxicity
docs = spark.createDataFrame([(i, ("one two three four five six %d " % (i // 2)) * 9) for i in range(12)], "doc_id bigint, text string")
labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(12)], "doc_id bigint, quality int, toxic int")
print(ngram_join.join_components(docs).count(), quality_rff.score_documents(docs, labels).count(), toxicity.score_documents(docs, labels).count(), fill_middle.fill_in_middle(docs).count())
spark.stop()
"""
    got = away(code)
    assert got.stdout.split() == ["12"] * 4, got.stderr[-3000:]
