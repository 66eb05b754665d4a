"""Operators on executors that have no copy of the package: the driver's path is not the workers'."""

import os
import subprocess
import sys

SCRIPT = """
import os, sys
sys.path.insert(0, {repo!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config(
    "spark.sql.shuffle.partitions", "2").getOrCreate()
def absent(_):
    import importlib.util
    yield importlib.util.find_spec("renown") is None
assert spark.sparkContext.parallelize([0], 1).mapPartitions(absent).collect() == [True]
from renown.llm import dialogue, packing, url_filter
from renown.llm.queries import tokenizer_path
docs = spark.createDataFrame([(1, "Some words, and more."), (2, None)], "doc_id long, text string")
assert packing.pack(docs, tokenizer_path()).count() == 2
talk = spark.createDataFrame([(1, 0, "user", "Hi."), (1, 1, "assistant", "Yes.")], "conv_id long, turn long, role string, text string")
assert dialogue.repair_report(talk).count() == 1
pages = spark.createDataFrame([(1, "http://a.com/x"), (2, "http://b.example.com/en/"), (3, "http://c.org")], "page_id long, url string")
assert url_filter.judge(pages).count() == 3
print("shipped")
"""


def test_workers_without_the_package(tmp_path):
    repo = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    script = tmp_path / "ship.py"
    script.write_text(SCRIPT.format(repo=repo))
    done = subprocess.run([sys.executable, str(script)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "shipped" in done.stdout, done.stderr[-3000:]
