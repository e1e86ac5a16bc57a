import numpy as np
import pytest
from pyspark.sql import functions as F

from clinspark.llm import neighbours


def brute(rows, is_query, k):
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], np.float32).astype(float)
    out = {}
    for i, v in zip(ids.tolist(), x, strict=True):
        if is_query(i):
            scores = (x * v).sum(axis=1)
            order = [j for j in np.lexsort((ids, -scores)) if ids[j] != i][:k]
            out[i] = [(int(ids[j]), float(scores[j])) for j in order]
    return out


def lists(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>")


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(12, 16))
    x = centres[rng.integers(0, 12, 3000)] + 0.3 * rng.normal(size=(3000, 16))  # of different lengths
    x[1000:1700] = x[5]  # a third are alike
    return [(int(i), [float(c) for c in np.float32(v)]) for i, v in enumerate(x)]


def test_factor_one_is_exact_with_ties_to_the_smaller_id(spark, rows):
    found = lists(neighbours.nearest(vectors(spark, rows), F.col("vec_id") % 50 == 0, k=20, factor=1.0, shards=3))
    wanted = brute(rows, lambda i: i % 50 == 0, 20)
    assert found.keys() == wanted.keys()
    for q, best in wanted.items():
        assert [i for i, _ in found[q]] == [i for i, _ in best]
        assert [s for _, s in found[q]] == pytest.approx([s for _, s in best], abs=1e-12)


def test_larger_factors_visit_less_and_keep_recall(spark, rows):
    wanted = brute(rows, lambda i: i % 20 == 0, 20)
    found = lists(neighbours.nearest(vectors(spark, rows), F.col("vec_id") % 20 == 0, factor=1.2))
    hits = sum(len({i for i, _ in best} & {i for i, _ in found[q]}) for q, best in wanted.items())
    assert hits / sum(len(b) for b in wanted.values()) >= 0.9


def test_fewer_candidates_than_asked(spark):
    rows = [(20, [1.0, 0.0]), (3, [0.5, 0.0]), (4, [-1.0, 2.0])]
    found = lists(neighbours.nearest(vectors(spark, rows), F.col("vec_id") % 20 == 0))
    assert found == {20: [(3, 0.5), (4, -1.0)]}


def test_what_takes_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (20, [1.0, 1.0]),
        (40, None),
        (60, []),
        (80, [0.0, 0.0]),
        (100, [nan, 1.0]),
        (120, [inf, 1.0]),
        (140, [None, 1.0]),
        (160, [1.0, 2.0, 3.0]),
        (None, [1.0, 1.0]),
        (7, [2.0, 2.0]),
        (7, [1.0, 5.0]),
        (20, [1.0, 1.0]),
        (9, [0.0, 1.0]),
    ]
    found = lists(neighbours.nearest(vectors(spark, rows), F.col("vec_id") % 20 == 0))
    assert found == {20: [(7, 6.0), (7, 4.0), (9, 1.0)]}


def test_vectors_of_other_lengths_have_neighbours_of_their_own(spark):
    rows = [(20, [1.0, 1.0]), (40, [1.0, 2.0, 3.0]), (1, [2.0, 1.0]), (2, [1.0, 1.0, 1.0]), (3, [0.0, 0.0, 1.0]), (60, [4.0])]
    found = lists(neighbours.nearest(vectors(spark, rows), F.col("vec_id") % 20 == 0))
    assert found == {20: [(1, 3.0)], 40: [(2, 6.0), (3, 3.0)]}


def test_scores_are_those_of_double_vectors(spark):
    x, y = [0.1, 1e-9, 3.0], [0.2, 0.7, 1.0 / 3.0]
    frame = spark.createDataFrame([(20, x), (1, y)], "vec_id long, embedding array<double>")
    row = neighbours.nearest(frame, F.col("vec_id") % 20 == 0).first()
    assert row["score"] == sum(a * b for a, b in zip(x, y, strict=True))


def test_a_third_of_the_rows_share_an_id(spark):
    """Rows of one id, all different, are all candidates of the others and none of that id."""
    rng = np.random.default_rng(3)
    x = np.float32(rng.normal(size=(900, 6)))
    rows = [(40 if i % 3 == 0 else i + 1 if i % 7 else 60, [float(c) for c in v]) for i, v in enumerate(x)]
    rows += rows[:30]  # and repeated rows
    found = lists(neighbours.nearest(vectors(spark, rows), F.col("vec_id") % 20 == 0, k=25, shards=3))
    ids, every = np.array([i for i, _ in rows]), np.array([v for _, v in rows])
    for q in {i for i in ids.tolist() if i % 20 == 0}:
        query = np.array(min(v for i, v in rows if i == q))
        scores = (every * query).sum(axis=1)
        best = [j for j in np.lexsort((ids, -scores)) if ids[j] != q][:25]
        assert [i for i, _ in found[q]] == ids[best].tolist()
        assert [s for _, s in found[q]] == pytest.approx(scores[best].tolist(), abs=1e-12)


def test_recall_on_vectors_without_clusters(spark):
    rng = np.random.default_rng(8)
    rows = [(int(i), [float(c) for c in v]) for i, v in enumerate(np.float32(rng.uniform(-1, 1, size=(4000, 24))))]
    wanted = brute(rows, lambda i: i % 20 == 0, 20)
    found = lists(neighbours.nearest(vectors(spark, rows), F.col("vec_id") % 20 == 0, factor=1.2))
    hits = sum(len({i for i, _ in best} & {i for i, _ in found[q]}) for q, best in wanted.items())
    assert hits / sum(len(b) for b in wanted.values()) >= 0.9


def test_empty_table_and_extra_columns(spark):
    empty = vectors(spark, [])
    assert neighbours.nearest(empty, F.col("vec_id") % 20 == 0).collect() == []
    one = vectors(spark, [(20, [1.0]), (1, [2.0])]).withColumns({"shard": F.lit("x"), "kind": F.lit("y"), "score": F.lit(1)})
    assert lists(neighbours.nearest(one, F.col("vec_id") % 20 == 0)) == {20: [(1, 2.0)]}


def test_given_vectors(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in table.collect()]
    wanted = brute(rows, lambda i: i % 20 == 0, 20)
    found = lists(neighbours.nearest(table, F.col("vec_id") % 20 == 0, factor=1.2))
    hits = sum(len({i for i, _ in best} & {i for i, _ in found[q]}) for q, best in wanted.items())
    assert hits / sum(len(b) for b in wanted.values()) >= 0.9
