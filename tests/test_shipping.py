"""Tasks must not need the package on their import path."""

import subprocess
import sys
from pathlib import Path

SCRIPT = """
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
from millrace.operators import bm25, dense, embed
units = spark.createDataFrame(
    [("d", 0, "d_chunk0", "one two"), ("d", 1, "d_chunk1", "two")],
    "source_doc string, chunk_idx int, chunk_id string, text string",
)
queries = spark.createDataFrame([(1, "one")], "query_id long, text string")
found = bm25.keyword_topk(bm25.build_index(units), queries, 1)
vectors = embed.encode(units, lambda: lambda texts: [[len(t), 1.0] for t in texts])
asked = embed.encode(queries, lambda: lambda texts: [[len(t), 1.0] for t in texts])
near = dense.vector_topk(vectors, asked, bm25.KEYS, 1)
print("FOUND", found.first()["chunk_idx"], near.first()["chunk_idx"])
"""


def test_search_from_another_folder(tmp_path):
    root = str(Path(__file__).resolve().parent.parent)
    done = subprocess.run(
        [sys.executable, "-c", SCRIPT.format(root=root)],
        cwd=tmp_path,
        capture_output=True,
        text=True,
        timeout=240,
    )
    assert "FOUND 0 1" in done.stdout, done.stderr[-2000:]
