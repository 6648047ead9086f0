"""The forest index: recall against all pairs, hot prefixes, reopening, defined cases."""

import os
import random

import pytest
from pyspark.sql import functions as F

from molspark.operators import forest_index, similarity

SCHEMA = "dataset_id string, id long, fingerprint array<int>"


def near_sets(n, seed, dataset="a", first=0):
    """Sets in families of five that share most bits."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        if i % 5 == 0:
            base = rng.sample(range(2048), 60)
        bits = set(base) - set(rng.sample(base, rng.randint(0, 12))) | set(rng.sample(range(2048), rng.randint(0, 12)))
        rows.append((dataset, first + i, sorted(bits)))
    return rows


def exact(rows, query, k):
    """The k nearest distinct sets of the query's dataset, as (distance, least id)."""
    sets = {}
    for d, i, bits in rows:
        if d == query[0] and bits:
            sets.setdefault(tuple(bits), []).append(i)
    asked = set(query[2])
    return sorted((1 - len(asked & set(s)) / len(asked | set(s)), min(ids)) for s, ids in sets.items())[:k]


@pytest.fixture(scope="module")
def rows():
    return near_sets(300, 1) + near_sets(100, 2, "b")


@pytest.fixture(scope="module")
def index(spark, rows, tmp_path_factory):
    nodes = spark.createDataFrame(rows, SCHEMA)
    return forest_index.build(nodes, str(tmp_path_factory.mktemp("index") / "f"), trees=32, depth=4)


def test_recall(spark, rows, index):
    asked = near_sets(20, 1) + near_sets(10, 2, "b") + near_sets(5, 9, "c")
    found = {}
    for r in forest_index.nearest(index, spark.createDataFrame(asked, SCHEMA), 4, enough=64, per_tree=8).collect():
        found.setdefault((r.dataset_id, r.id), []).append((r.dist, r.neighbour, r.rank))
    hits = total = 0
    for q in asked:
        got, want = sorted(found.get(q[:2], [])), exact(rows, q, 4)
        assert [r for _, _, r in got] == list(range(1, len(got) + 1))
        for dist, neighbour, _ in got:
            assert dist == pytest.approx(exact([x for x in rows if x[1] == neighbour], q, 1)[0][0])
        hits += len({n for _, n, _ in got} & {n for _, n in want})
        total += len(want)
    assert total == 120 and hits >= 0.95 * total
    assert not any(d == "c" for d, _ in found)


def test_everything_is_offered_when_asked_for(spark, rows, index):
    """With room for all leaves the shortest shared prefixes are used, and the answer is nearly all nodes."""
    asked = spark.createDataFrame(rows[:3], SCHEMA)
    few = forest_index.candidates(index, asked, enough=1, per_tree=300).count()
    many = forest_index.candidates(index, asked, enough=10**9, per_tree=300).count()
    assert 3 <= few < many <= 900


def test_hot_prefix_is_bounded(spark, tmp_path):
    """Half of all rows are one family that shares most prefixes; a query still takes few of them."""
    family = [("a", i, sorted({*range(400), 500 + i})) for i in range(400)]
    rows = family + near_sets(400, 3, first=1000)
    index = forest_index.build(spark.createDataFrame(rows, SCHEMA), str(tmp_path / "f"), trees=16, depth=4)
    asked = spark.createDataFrame([("a", 7, family[7][2])], SCHEMA)
    assert forest_index.candidates(index, asked, enough=32, per_tree=8).count() <= 16 * 8
    near = forest_index.nearest(index, asked, 5, enough=32, per_tree=8).collect()
    assert len(near) == 5 and all(r.neighbour < 400 and r.dist < 0.01 for r in near)


def test_reopened_index_answers_alike(spark, rows, tmp_path):
    nodes = spark.createDataFrame(rows, SCHEMA)
    built = forest_index.build(nodes, str(tmp_path / "f"), trees=8, depth=3)
    again = forest_index.open_index(spark, str(tmp_path / "f"))
    assert (again.trees, again.depth) == (8, 3)
    asked = nodes.where("id < 10")
    answers = [sorted(forest_index.nearest(i, asked, 3).collect()) for i in (built, again)]
    assert answers[0] == answers[1]
    assert {r.id for r in answers[0] if r.dist == 0} == set(range(10))


def test_copies_and_missing_fingerprints(spark, tmp_path):
    rows = [("a", 5, [1, 2, 3]), ("a", 2, [1, 2, 3]), ("a", 9, [1, 2, 3]), ("a", 3, [1, 2, 4]), ("a", 4, []), ("a", 6, None)]
    nodes = spark.createDataFrame(rows, SCHEMA).withColumn("pos", F.lit(1)).withColumn("tree", F.lit("x"))
    index = forest_index.build(nodes, str(tmp_path / "f"), trees=8, depth=2)
    assert sorted(r.id for r in index.nodes.collect()) == [2, 3]
    assert sorted((r.id, r["copy"]) for r in index.copies.collect()) == [(2, 5), (2, 9)]
    got = forest_index.nearest(index, nodes, 1).collect()
    assert sorted((r.id, r.neighbour, r.dist) for r in got) == [(2, 2, 0.0), (3, 3, 0.0), (5, 2, 0.0), (9, 2, 0.0)]


def test_empty(spark, rows, index, tmp_path):
    none = spark.createDataFrame([], SCHEMA)
    assert forest_index.nearest(index, none).collect() == []
    empty = forest_index.build(none, str(tmp_path / "f"))
    assert forest_index.nearest(empty, spark.createDataFrame(rows[:2], SCHEMA)).collect() == []


def test_recall_on_documents(spark):
    """At least 0.9 of the ten nearest of every language are found in the whole documents."""
    from workload import graphs

    nodes = graphs._written_nodes(spark, "/root/testdata/sf0.001")
    rows = [tuple(r) for r in nodes.select("dataset_id", "id", "fingerprint").collect()]
    found = {}
    for r in graphs.forest_query(spark, "/root/testdata/sf0.001").collect():
        found.setdefault((r.dataset_id, r.id), []).append(r.dist)
    for q in rows:
        if q[1] % 50 == 0:
            want = exact(rows, q, similarity.NEIGHBOURS)
            assert sum(d <= want[-1][0] + 1e-9 for d in found[q[:2]]) >= 0.9 * len(want)


def test_unfinished_build_is_not_opened(spark, rows, tmp_path):
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "f" / "leaves"))
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        forest_index.open_index(spark, str(tmp_path / "f"))


def test_only_the_index_outlives_its_build(spark, rows, tmp_path):
    root = spark.conf.get("spark.checkpoint.dir")
    before = set(os.listdir(root)) if os.path.isdir(root) else set()
    forest_index.build(spark.createDataFrame(rows, SCHEMA), str(tmp_path / "f"), trees=4, depth=4)
    assert {f for f in set(os.listdir(root)) - before if f.startswith("molspark-")} == set()


def test_slices_of_trees_and_queries_answer_alike(spark, rows, tmp_path, monkeypatch):
    """Trees built one by one, blocks of a few positions and queries in parts: the answers are the same."""
    asked = spark.createDataFrame(rows[:40] + near_sets(10, 2, "b"), SCHEMA)
    nodes = spark.createDataFrame(rows, SCHEMA)

    def answers(name):
        index = forest_index.build(nodes, str(tmp_path / name), trees=8, depth=3)
        near = forest_index.nearest(index, asked, 4, enough=64, per_tree=8).collect()
        return index, sorted(near), sorted(forest_index.candidates(index, asked, 64, 8).collect())

    _, near, candidates = answers("whole")
    monkeypatch.setattr(forest_index, "LEAVES_AT_ONCE", 1)
    monkeypatch.setattr(forest_index, "TREE_SLICES", 5)
    monkeypatch.setattr(forest_index, "BLOCK", 6)
    monkeypatch.setattr(forest_index, "QUERIES_AT_ONCE", 20)
    index, *cut = answers("cut")
    assert cut == [near, candidates]
    assert index.leaves.selectExpr("max(size(ids))").head()[0] == 6
