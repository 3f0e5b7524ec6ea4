import numpy as np
import pytest
from pyspark.errors import PySparkException

from millrace.operators import dense
from tests.conftest import rows


def cosine(a, b):
    lengths = np.linalg.norm(a) * np.linalg.norm(b)
    return float(np.dot(a, b) / lengths) if lengths else 0.0


def best(vectors, query, k, digits=6):
    scored = [(-round(cosine(v, query), digits), i) for i, v in enumerate(vectors)]
    return [(i, -s) for s, i in sorted(scored)[:k]]


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(3)
    made = rng.normal(size=(300, 8)).astype(np.float32)
    made[50:150] = made[0]  # a third of the vectors are copies of one
    made[200] = 0
    made[201] = made[0] * 5
    return made


def frame(spark, name, made):
    return spark.createDataFrame(
        [(i, v.tolist()) for i, v in enumerate(made)], f"{name} long, embedding array<float>"
    )


@pytest.mark.parametrize("options", [{}, {"max_numbers": 40}, {"max_numbers": 1}])
def test_equals_brute_force(spark, vectors, options):
    queries = np.vstack([vectors[[0, 7, 200, 299]], -vectors[0]])
    found = dense.vector_topk(
        frame(spark, "vec_id", vectors).repartition(4),
        frame(spark, "query_id", queries),
        ["vec_id"],
        10,
        6,
        **options,
    )
    assert found.columns == ["query_id", "vec_id", "score", "rk"]
    got = {i: [] for i in range(len(queries))}
    for r in found.orderBy("query_id", "rk").collect():
        got[r["query_id"]].append((r["vec_id"], r["score"]))
    for i, q in enumerate(queries):
        assert [v for v, _ in got[i]] == [v for v, _ in best(vectors, q, 10)]
        assert [s for _, s in got[i]] == pytest.approx(
            [s for _, s in best(vectors, q, 10)], abs=2e-6
        )


def test_small_batches_and_query_blocks(spark, vectors, monkeypatch):
    monkeypatch.setattr(dense, "QUERY_BLOCK", 3)
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 9)
    try:
        found = dense.vector_topk(
            frame(spark, "vec_id", vectors), frame(spark, "query_id", vectors[:8]), ["vec_id"], 4, 6
        )
        got = rows(found.select("query_id", "rk", "vec_id"), "query_id", "rk")
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    assert got == [
        (q, rk, v) for q in range(8) for rk, (v, _) in enumerate(best(vectors, vectors[q], 4), 1)
    ]


def test_no_vectors_and_no_queries(spark, vectors):
    some, none = frame(spark, "vec_id", vectors), frame(spark, "query_id", [])
    assert dense.vector_topk(some, none, ["vec_id"], 3).count() == 0
    queries = frame(spark, "query_id", vectors[:2])
    assert dense.vector_topk(some.where("false"), queries, ["vec_id"], 3).count() == 0


def test_missing_and_uneven_vectors(spark, vectors):
    queries = frame(spark, "query_id", vectors[:1])
    schema = "vec_id long, embedding array<float>"
    some = spark.createDataFrame([(1, vectors[0].tolist()), (2, None)], schema)
    found = dense.vector_topk(some, queries, ["vec_id"], 3)
    assert rows(found.select("vec_id", "score")) == [(1, pytest.approx(1.0))]
    # A number that is none would come out on top of every comparison.
    for wrong in (float("nan"), float("inf"), None):
        odd = spark.createDataFrame([(1, [1.0] * 7 + [wrong])], schema)
        with pytest.raises(PySparkException, match="finite numbers"):
            dense.vector_topk(odd, queries, ["vec_id"], 3).collect()
    # Seven and nine numbers would fill two rows of eight.
    uneven = spark.createDataFrame([(1, [1.0] * 7), (2, [1.0] * 9)], schema).coalesce(1)
    with pytest.raises(PySparkException, match="numbers, not 8"):
        dense.vector_topk(uneven, queries, ["vec_id"], 3).collect()


def test_cells(spark, vectors):
    queries = frame(spark, "query_id", vectors[250:260])
    some = frame(spark, "vec_id", vectors)
    exact = dense.vector_topk(some, queries, ["vec_id"], 5, 6)
    cells = dense.build_cells(some, ["vec_id"], 6)
    assert cells.vectors.count() == len(vectors)
    everywhere = dense.cell_topk(cells, queries, ["vec_id"], 5, n_probe=6, digits=6)
    assert rows(everywhere) == rows(exact)
    near = dense.cell_topk(cells, queries, ["vec_id"], 5, n_probe=1, digits=6)
    # Nothing but the unread cells is missing: the result is exact within a cell.
    cell_of = {r["vec_id"]: r["cell"] for r in cells.vectors.collect()}
    unit = vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-30)
    got = rows(near.select("query_id", "rk", "vec_id"), "query_id", "rk")
    for q in range(10):
        cell = int(np.argmax(unit[250 + q] @ cells.centers.T))
        members = [i for i in range(len(vectors)) if cell_of[i] == cell]
        want = [members[i] for i, _ in best(vectors[members], vectors[250 + q], 5)]
        assert [v for query, _, v in got if query == q] == want
    found = dense.recall(exact, near, ["vec_id"])
    assert all(r["n_exact"] == 5 and 1 <= r["n_found"] <= 5 for r in found.collect())
    assert found.count() == 10
    # Folders of other cells are left unread.
    one = dense.cell_topk(cells, queries.where("query_id = 0"), ["vec_id"], 5, n_probe=1)
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "(cell#" in plan.split("PartitionFilters: ")[1].split("PushedFilters")[0]


def test_raw_scores_rank_by_default(spark):
    """Two vectors whose cosines differ by less than six decimals show."""
    near, nearer = [1.0, 2e-4], [1.0, 1e-4]
    some = spark.createDataFrame([(1, near), (2, nearer)], "vec_id long, embedding array<double>")
    query = spark.createDataFrame([(0, [1.0, 0.0])], "query_id long, embedding array<double>")
    found = dense.vector_topk(some, query, ["vec_id"], 2)
    assert rows(found.select("rk", "vec_id")) == [(1, 2), (2, 1)]
    rounded = dense.vector_topk(some, query, ["vec_id"], 2, digits=6)
    assert rows(rounded.select("rk", "vec_id")) == [(1, 1), (2, 2)]


def test_one_pass_at_a_time(spark, vectors, monkeypatch):
    """Several passes: each part of the queries is taken back before the next is sent."""
    live, most, encoded = [], [], spark.sparkContext.accumulator(0)
    broadcast = type(spark.sparkContext).broadcast

    class Watched:
        def __init__(self, real):
            self.real, self.value = real, real.value
            live.append(self)
            most.append(len(live))

        def __reduce__(self):
            return self.real.__reduce__()

        def destroy(self):
            live.remove(self)
            self.real.destroy()

    monkeypatch.setattr(
        type(spark.sparkContext), "broadcast", lambda self, value: Watched(broadcast(self, value))
    )

    def encode(batches):
        for batch in batches:
            encoded.add(len(batch))
            yield batch

    queries = frame(spark, "query_id", vectors[:5])
    queries = queries.mapInPandas(encode, queries.schema)
    found = dense.vector_topk(frame(spark, "vec_id", vectors), queries, ["vec_id"], 2, 6, max_numbers=10)
    assert found.count() == 10
    assert len(most) > 1 and max(most) == 1 and not live
    assert encoded.value == 5
