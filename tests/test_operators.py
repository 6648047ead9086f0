"""Operators on small tables, against values worked out by hand or by brute force."""

import hashlib
import itertools
import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from molspark.functions import columns, kernel, lookup
from molspark.functions.kernel import text_kernel, text_prepare
from molspark.functions.lookup import skew_safe_lookup
from molspark.functions.ordering import dense_index, sorted_position
from molspark.functions.rounding import round_exact
from molspark.operators import clustering, descriptors, gates, layers, predict, silhouette, similarity, spanning_tree
from molspark.operators import enumerate as library
from molspark.sources import listing, pairs, people, tables

KERNEL = text_kernel()


def one(spark, value, expr):
    return spark.createDataFrame([(value,)], "s string").select(expr(F.col("s"))).head()[0]


# --- Kernel ---------------------------------------------------------------------------------


@pytest.mark.parametrize(
    ("text", "valid"),
    [("CCO", True), ("c1ccccc1", True), ("C1CC", False), ("CC(", False), ("[13C]#N", True), ("", False),
     ("NOT_A_MOLECULE", False), ("C%12CC%12", True), ("C%12CC", False), (None, False), ("C" * 50_000, True),
     ("C1CC2", False), (")(", False), ("C(C))(C", False), ("C1CC1C1CC1", True), ("C%01CC1", True),
     ("C12CC1CC2", True), ("C(C(C)C)C", True), ("C1CC1CC1", False)],
)
def test_validity(spark, text, valid):
    assert one(spark, text, KERNEL.is_valid) is valid


@pytest.mark.parametrize(
    ("text", "welded"),
    [("c1ccccc1[*:1]", "c1ccccc1-%91"), ("[*:1]CC", "C-%91C"), ("C([*:2])C", "C-%92C"),
     ("[*:1]", None), ("C(F)[*:1]", None), ("C=[*:1]", None), ("C*", None), ("C[*:10]", None),
     ("[C@H][*:1]", None), ("C%91C[*:1]", None)],
)
def test_weld(spark, text, welded):
    got = one(spark, text, text_prepare)
    assert (got["text"] if got else None) == welded


def test_descriptors(spark):
    df = spark.createDataFrame([("c1ccccc1Cl",), ("CC(=O)[NH3+]",), ("bad text",), (None,), ("Brc1ccncc1",)], "smiles string")
    got = {r["smiles"]: r for r in descriptors.with_descriptors(df, KERNEL).collect()}
    assert set(got) == {"c1ccccc1Cl", "CC(=O)[NH3+]", "Brc1ccncc1"}
    r = got["c1ccccc1Cl"]
    assert (r["n_heavy_atoms"], r["n_hetero_atoms"], r["n_halogens"], r["n_aromatic_atoms"], r["n_rings"]) == (7, 1, 1, 6, 1)
    assert r["heavy_atom_weight"] == round(6 * 12.011 + 35.45, 4)
    r = got["CC(=O)[NH3+]"]
    assert (r["n_heavy_atoms"], r["n_hetero_atoms"], r["n_branches"]) == (4, 2, 1)
    assert r["heavy_atom_weight"] == round(2 * 12.011 + 15.999 + 14.007, 4)


# --- Enumeration ----------------------------------------------------------------------------


def library_tables(spark, sizes, scaffold):
    rows = [
        ("d", label, i, f"[*:{k}]{'C' * (i + 1)}")
        for k, (label, n) in enumerate(sizes.items(), 1)
        for i in range(n)
    ]
    return (
        spark.createDataFrame([("d", 7, scaffold)], "dataset_id string, scaffold_id long, smiles string"),
        spark.createDataFrame(rows, "dataset_id string, label string, pos long, smiles string"),
    )


@pytest.mark.parametrize("cap", [1, 10, 27, 100])
def test_cap_takes_the_prefix(spark, cap):
    sizes = {"R1": 3, "R2": 3, "R10": 3}
    scaffolds, groups = library_tables(spark, sizes, "C([*:1])C([*:2])C[*:3]")
    got = sorted((r["ord"], r["r_groups"]) for r in library.attempts(scaffolds, groups, KERNEL, cap).collect())
    fragments = {label: [f"[*:{k}]{'C' * (i + 1)}" for i in range(3)] for k, label in enumerate(sizes, 1)}
    order = sorted(sizes)
    assert order == ["R1", "R10", "R2"]
    want = [dict(zip(order, c)) for c in itertools.product(*(fragments[x] for x in order))][:cap]
    assert [g for _, g in got] == want


def test_long_lists_cross_chunks(spark):
    sizes = {"A": 7, "B": 3000}
    scaffolds, groups = library_tables(spark, sizes, "C([*:1])C[*:2]")
    cap = 12_345
    rows = library.attempts(scaffolds, groups, KERNEL, cap).select("ord", "r_groups").collect()
    assert len(rows) == cap
    for r in rows:
        assert len(r["r_groups"]["A"]) - 5 == r["ord"] // 3000 + 1 - 0
        assert len(r["r_groups"]["B"]) - 5 == r["ord"] % 3000 + 1


def test_scaffolds_share_the_fragments_of_a_chunk(spark):
    scaffolds, groups = library_tables(spark, {"A": 3, "B": 5}, "C([*:1])C[*:2]")
    many = scaffolds.select("dataset_id", F.explode(F.sequence(F.lit(1), F.lit(40)).cast("array<long>")).alias("scaffold_id"), "smiles")
    sized = library.sized_scaffolds(many, groups, KERNEL, 12).withColumn("_scaffold", KERNEL.prepare(F.col("smiles")))
    crews = library._crews(sized, ["_scaffold"])
    # One row per crew and label, not per scaffold and label.
    assert library._chunks(crews, ["crew"]).count() == 2 * -(-40 // library.SCAFFOLDS_PER_CREW)
    rows = library.attempts(many, groups, KERNEL, 12).collect()
    assert sorted((r["scaffold_id"], r["ord"]) for r in rows) == [(s, o) for s in range(1, 41) for o in range(12)]
    for r in rows:
        assert (len(r["r_groups"]["A"]) - 6, len(r["r_groups"]["B"]) - 6) == divmod(r["ord"], 5)
    decoded = library.attempts(many, groups, KERNEL, 12)._jdf.queryExecution().optimizedPlan().toString()
    # Nothing is decoded a second time to see whether there are rows.
    assert not [x for x in decoded.splitlines() if "Filter" in x and "sequence(_first" in x]


def test_first_seen_wins_over_scaffolds(spark):
    made = spark.createDataFrame(
        [("d", 2, 0, "X"), ("d", 1, 5, "X"), ("d", 1, 3, "Y"), ("e", 9, 9, "X")],
        "dataset_id string, scaffold_id long, ord long, smiles string",
    )
    got = library.first_seen_distinct(made, ["dataset_id", "smiles"], ["scaffold_id", "ord"])
    assert {tuple(r) for r in got.collect()} == {("d", "X", 1, 5), ("d", "Y", 1, 3), ("e", "X", 9, 9)}


def test_long_and_wide_loading_agree(spark):
    wide = spark.createDataFrame(
        [("d", 0, " [*:1]C ", "[*:2]C"), ("d", 1, "[*:1]C", ""), ("d", 2, None, "[*:2]C"), ("d", 3, "[*:1]N", "[*:2]O")],
        "dataset_id string, pos long, R1 string, R2 string",
    )
    a = library.load_r_groups(wide, ["R1", "R2"], KERNEL)
    b = library.load_r_group_cells(columns.melt(wide, ["dataset_id", "pos"], ["R1", "R2"]), KERNEL)
    key = lambda r: (r["pos"], r["label"], r["smiles"])
    assert sorted(map(key, a.collect())) == sorted(map(key, b.collect()))
    assert {r["pos"] for r in a.collect()} == {0, 3}


# --- Gates ----------------------------------------------------------------------------------


def test_validity_boundary(spark):
    rows = [("a", t) for t in ["C"] * 4 + ["x"]] + [("b", t) for t in ["C"] * 3 + ["x"]] + [("c", None), ("c", "")]
    df = spark.createDataFrame(rows, "dataset_id string, smiles string")
    ids = spark.createDataFrame([("a",), ("b",), ("c",), ("none",)], "dataset_id string")
    got = {r["dataset_id"]: r for r in gates.validity_gate(df, gates.cell_is_valid(F.col("smiles"), KERNEL), datasets=ids).collect()}
    assert got["a"]["passed"] and got["a"]["valid_ratio"] == 0.8
    assert not got["b"]["passed"]
    assert (got["c"]["valid"], got["c"]["invalid"]) == (1, 1)
    assert (got["none"]["total"], got["none"]["passed"]) == (0, False)


def test_balance_boundary(spark):
    sizes = [("a", 0, 9), ("a", 1, 1), ("b", 0, 10), ("b", 1, 1)]
    df = spark.createDataFrame(sizes, "dataset_id string, cluster int, size long")
    ids = spark.createDataFrame([("a",), ("b",), ("none",)], "dataset_id string")
    got = {r["dataset_id"]: r for r in gates.balance_gate(df, datasets=ids).collect()}
    assert got["a"]["passed"] and not got["b"]["passed"]
    assert (got["none"]["largest_cluster_ratio"], got["none"]["passed"]) == (1.0, False)


def test_failed_gate_raises_with_its_report(spark):
    reports = spark.createDataFrame(
        [("a", "g", False, '{"n":0}')], "dataset_id string, gate string, passed boolean, report string"
    )
    with pytest.raises(gates.DataQualityError) as caught:
        gates.raise_on_failure(reports)
    assert caught.value.report["gate"] == "g"
    gates.raise_on_failure(reports.where("passed"))


# --- Ordering, lookup, rounding, columns ----------------------------------------------------


def test_positions_of_sparse_values(spark):
    df = spark.range(300).select((F.col("id") * 10_000_000_019).alias("k"), F.lit(None).cast("string").alias("g"))
    assert [r["i"] for r in dense_index(df, "k", ["g"], "i").orderBy("k").collect()] == list(range(300))


def test_positions(spark):
    df = spark.range(1000).select((F.col("id") * 37 % 1000 * 11).alias("k"), (F.col("id") % 3).alias("g"))
    rows = dense_index(df, "k", ["g"], "i").collect()
    for g in range(3):
        mine = sorted((r["k"], r["i"]) for r in rows if r["g"] == g)
        assert [i for _, i in mine] == list(range(len(mine)))
    placed = sorted_position(df, ["g", "k"]).collect()
    assert [r["pos"] for r in sorted(placed, key=lambda r: (r["g"], r["k"]))] == list(range(1000))


def test_lookup_with_hot_keys(spark, monkeypatch):
    monkeypatch.setattr(lookup, "MAX_HOT_KEYS", 10)
    rows = spark.range(300).select("id", F.when(F.col("id") < 100, 0).otherwise(F.col("id") % 50).alias("k"))
    counted = rows.groupBy("k").agg(F.count(F.lit(1)).alias("uses")).where("k <> 7")
    table = counted.withColumn("v", F.col("k") * 10)
    got = skew_safe_lookup(rows, table, ["k"], "uses", 300).collect()
    want = {(r["id"], r["k"]) for r in rows.collect() if r["k"] != 7}
    assert {(r["id"], r["k"]) for r in got} == want and len(got) == len(want)
    assert all(r["v"] == r["k"] * 10 for r in got)


def test_rounding_is_by_stored_value(spark):
    rng = random.Random(1)
    values = [2.675, 0.125, 1.00005, -0.00005, 0.5] + [rng.randint(0, 10**7) / 1e5 + 0.00005 for _ in range(500)]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    for row in df.select("x", round_exact(F.col("x"), 4).alias("r")).collect():
        assert row["r"] == round(row["x"], 4)


def test_standard_columns(spark):
    df = spark.createDataFrame([("C", "m", 1)], " SMILE string, ` Compound_ID ` string, n int")
    assert columns.standard_columns(df).columns == ["smiles", "molecule id", "n"]
    with pytest.raises(ValueError, match="smiles"):
        columns.standard_columns(df.select("n"))


def test_colour_layers_without_columns(spark):
    df = spark.createDataFrame([("C", "m", 1)], "smiles string, `molecule id` string, line long")
    got, categories = layers.colour_layers(df, "line")
    assert categories == {"Default Map": False}
    assert got.head()["label"] == "C__ID: m"


def test_people_fallback(spark):
    df = spark.createDataFrame([(1, '{"number": 1, "people": [{"craft": "A", "name": "B"}]}'), (2, "oops")], "i int, payload string")
    got = people.read_people(df).collect()
    assert [(r["number"], r["craft"], r["name"]) for r in got if r["i"] == 1] == [(1, "A", "B")]
    assert len([r for r in got if r["i"] == 2]) == 12


def test_csv_columns_by_name_and_outer_blanks(spark, tmp_path):
    df = spark.createDataFrame([(" a ", '"q"', "x\ny")], "b string, a string, c string")
    path = tables.write_csv(df, str(tmp_path / "y"))
    got = tables.read_strings(spark, path, ["a", "b", "none", "c"], multi_line=True).collect()
    assert [tuple(r) for r in got] == [('"q"', " a ", None, "x\ny")]


def test_listing_has_empty_files(spark, tmp_path):
    for name, text in (("a.csv", "x"), ("b[1].csv", ""), ("sub/c d.csv", "yy")):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text(text)
    got = listing.list_keys(spark, str(tmp_path), "*.csv").collect()
    assert {(r["key"], r["length"]) for r in got} == {("a.csv", 1), ("b[1].csv", 0), ("sub/c d.csv", 2)}


def test_pairs_keep_quotes_breaks_and_blanks(spark, tmp_path):
    long_cell = "x," * 20_000
    (tmp_path / "a[1]_scaffolds.csv").write_text('name, Smiles \n"n ""1""\nm"," C "\nshort\n\n"",\n' + f'"{long_cell}",CC\n')
    (tmp_path / "b_scaffolds.csv").write_text("smiles\nO\n")
    (tmp_path / "a[1]_r_groups.csv").write_text("R1,R2,R3\nC,,\nN\n")
    (tmp_path / "b_r_groups.csv").write_text("")
    ids = spark.createDataFrame([("a[1]",), ("b",)], "dataset_id string")
    scaffolds, cells = pairs.read_pairs(spark, str(tmp_path), ids)
    got = [(r["dataset_id"], r["smiles"]) for r in scaffolds.orderBy("dataset_id", "scaffold_id").collect()]
    assert got == [("a[1]", "C"), ("a[1]", ""), ("a[1]", ""), ("a[1]", "CC"), ("b", "O")]
    rows = [(r["label"], r["smiles"]) for r in cells.orderBy("pos", "label").collect()]
    assert rows == [("R1", "C"), ("R2", ""), ("R3", ""), ("R1", "N"), ("R2", None), ("R3", None)]


def test_numbers_in_labels(spark):
    values = [0.0005, 12345678.0, 1e-5, 2.5e16, -1.5e-7, 0.1, 100.0, 1e15, 123456789.125, -0.00025]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    assert [r[0] for r in df.select(columns.plain_number(F.col("x"))).collect()] == [repr(v) for v in values]


def test_empty_csv_is_readable(spark, tmp_path):
    path = tables.write_csv(spark.createDataFrame([], "a string, b string"), str(tmp_path / "x"))
    assert tables.read_strings(spark, path, ["a", "b"]).count() == 0


# --- Clustering -----------------------------------------------------------------------------


def blobs(spark, n=60):
    rng = np.random.default_rng(0)
    rows = [
        (d, i, float(10 * (i % 3) + rng.normal()), float(-7 * (i % 3) + rng.normal()))
        for d in ("a", "b") for i in range(n)
    ]
    return spark.createDataFrame(rows, "dataset_id string, point_id long, x double, y double")


def test_kmeans_finds_blobs(spark):
    got = clustering.cluster_rows(blobs(spark), ["x", "y"], 3).toPandas()
    assert len(got) == 120
    for _, part in got.groupby("dataset_id"):
        assert set(part["cluster"]) == {0, 1, 2}
        assert part.assign(g=part["point_id"] % 3).groupby("g")["cluster"].nunique().max() == 1


def test_inertia_does_not_rise(spark):
    points = clustering.standardise(blobs(spark), ["x", "y"]).cache()
    centers = clustering.first_rows_as_centers(points, ["x", "y"], 4)
    costs = []
    for _ in range(4):
        costs.append(clustering.assign(points, centers, ["x", "y"], 4).agg(F.sum("distance")).head()[0])
        centers = clustering.lloyd(points, centers, ["x", "y"], 4, 1, tolerance=None)
    assert all(b <= a + 1e-9 for a, b in itertools.pairwise(costs))


def test_k_must_fit(spark):
    df = blobs(spark, 5).where("dataset_id = 'a'")
    assert clustering.cluster_rows(df, ["x", "y"], 5).count() == 5
    with pytest.raises(ValueError, match="k = 6"):
        clustering.cluster_rows(df, ["x", "y"], 6)
    with pytest.raises(ValueError, match="no rows"):
        clustering.cluster_rows(df.limit(0), ["x", "y"], 2)
    with pytest.raises(ValueError, match="lack feature"):
        clustering.feature_frame(df, ["nope"])


def test_constant_feature_becomes_zero(spark):
    df = blobs(spark).withColumn("x", F.lit(0.1))
    assert clustering.standardise(df, ["x"]).agg(F.max(F.abs("x"))).head()[0] == 0.0


def brute_silhouette(x, labels, power):
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1)) ** power
    scores = []
    for i in range(len(x)):
        own = labels == labels[i]
        if own.sum() == 1:
            scores.append(0.0)
            continue
        a = d[i, own].sum() / (own.sum() - 1)
        b = min(d[i, labels == c].mean() for c in set(labels) - {labels[i]})
        scores.append((b - a) / max(a, b))
    return float(np.mean(scores))


def test_silhouettes_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(silhouette, "POINTS_PER_BLOCK", 16)
    rng = np.random.default_rng(3)
    x = np.vstack([rng.integers(0, 6, (90, 2)).astype(float), [[50.0, 50.0]]])
    labels = np.append(rng.integers(0, 3, 90), 3)
    rows = [("d", i, float(a), float(b), int(c)) for i, ((a, b), c) in enumerate(zip(x, labels))]
    df = spark.createDataFrame(rows, "dataset_id string, point_id long, x double, y double, cluster int")
    exact = silhouette.euclidean_silhouette(df, ["x", "y"]).head()["silhouette"]
    assert math.isclose(exact, brute_silhouette(x, labels, 1), rel_tol=1e-9)
    squared = silhouette.squared_silhouette(df, ["x", "y"], 4).head()["silhouette"]
    assert math.isclose(squared, brute_silhouette(x, labels, 2), rel_tol=1e-9)


def test_choose_k(spark):
    points = clustering.standardise(blobs(spark, 30), ["x", "y"]).cache()
    assert {r["k"] for r in silhouette.choose_k(points, ["x", "y"], 2, 4).collect()} == {3}
    exact = silhouette.choose_k(points, ["x", "y"], 2, 4, metric=silhouette.EUCLIDEAN).collect()
    assert {(r["k"], r["metric"]) for r in exact} == {(3, "euclidean")}
    ranged = clustering.cluster_rows(blobs(spark, 30), ["x", "y"], 2, auto_k_range=(2, 4))
    assert {r["n_clusters"] for r in clustering.cluster_stats(ranged).collect()} == {3}
    few = points.where("point_id < 2").cache()
    assert {r["k"] for r in silhouette.choose_k(few, ["x", "y"]).collect()} == {2}


def test_blocks_hold_each_distinct_point_once(spark, monkeypatch):
    monkeypatch.setattr(clustering, "BLOCK_VALUES", 20)
    points = spark.createDataFrame(
        [("a", 0, 1.0, 2.0)] * 500 + [("a", i, float(i), 0.5) for i in range(100)] + [("b", 1, -0.0, 0.0), (None, 1, 0.0, 0.0)],
        "dataset_id string, point_id long, x double, y double",
    )
    rows = clustering.point_blocks(points, ["x", "y"]).collect()
    got = sorted((r["dataset_id"], x, y, w) for r in rows for x, y, w in zip(r["x"], r["y"], r["_weight"]))
    assert got == sorted([("a", 1.0, 2.0, 500), *(("a", float(i), 0.5, 1) for i in range(100)), ("b", 0.0, 0.0, 1)])
    assert max(len(r["x"]) for r in rows) < 40


def test_choose_k_is_that_of_runs_of_their_own(spark, monkeypatch):
    """The runs of all k share draws and blocks of points; each gives what K-means for that k alone gives."""
    rng = np.random.default_rng(3)
    rows = [("a", i, *rng.normal(size=2).tolist()) for i in range(150)] + [("a", 500 + i, 9.0, 9.0) for i in range(60)]
    rows += [("b", i, float(i % 2), 0.0) for i in range(9)] + [("c", i, float(i), 1.0) for i in range(3)] + [("d", 1, 0.0, 0.0)]
    points = spark.createDataFrame(rows, "dataset_id string, point_id long, x double, y double")
    drawn, draw = [], clustering.spread_centers
    monkeypatch.setattr(clustering, "spread_centers", lambda p, *rest: drawn.append(p.count()) or draw(p, *rest))
    monkeypatch.setattr(clustering, "BLOCK_VALUES", 64)
    got = {r["dataset_id"]: (r["k"], r["silhouette"]) for r in silhouette.choose_k(points, ["x", "y"], 2, 4).collect()}
    assert drawn == [len(rows)]  # not one copy a value of k
    scores = {}
    for k in (2, 3, 4):
        enough = points.where(F.col("dataset_id").isin([d for d, n in (("a", 210), ("b", 9), ("c", 3)) if n > k]))
        centers = clustering.kmeans_centers(enough, ["x", "y"], k)
        labelled = clustering.assign(enough, centers, ["x", "y"], k).toPandas()
        for name, part in labelled.groupby("dataset_id"):
            if part["cluster"].nunique() > 1:
                scores[name, k] = brute_silhouette(part[["x", "y"]].to_numpy(), part["cluster"].to_numpy(), 2)
    assert set(got) == {"a", "b", "c", "d"} and got["d"] == (1, None)
    for name in "abc":
        best = max((s, -k) for (d, k), s in scores.items() if d == name)
        assert got[name][1] == pytest.approx(best[0])
        assert scores[name, got[name][0]] == pytest.approx(best[0])


# --- Similarity -----------------------------------------------------------------------------


def test_forest_pairs_near_copies_without_all_pairs(spark):
    """A third of the nodes are near copies: each still meets a bounded number of others."""
    rng = random.Random(5)
    common = rng.sample(range(2048), 60)
    rows = []
    for i in range(300):
        bits = set(common) ^ {rng.randrange(2048)} if i < 100 else set(rng.sample(range(2048), 60))
        rows.append(("d", i, sorted(bits)))
    nodes = spark.createDataFrame(rows, "dataset_id string, id long, fingerprint array<int>")
    trees, reach = 8, 2
    pairs = similarity.forest_candidates(nodes, trees, 4, reach)
    got = [(r["src"], r["dst"]) for r in pairs.collect()]
    assert len(got) == len(set(got)) <= 300 * trees * reach
    near = similarity.nearest_neighbours(similarity.jaccard_distance(pairs, nodes), 3).collect()
    sets = {i: set(b) for _, i, b in rows}
    for r in near:
        a, b = sets[r["id"]], sets[r["neighbour"]]
        assert math.isclose(r["dist"], 1 - len(a & b) / len(a | b))
    assert all(r["neighbour"] < 100 for r in near if r["id"] < 100)


def test_copies_become_one_node(spark):
    rows = [("d", i, [1, 2, 3] if i < 50 else [i, i + 1]) for i in range(60)]
    nodes = spark.createDataFrame(rows, "dataset_id string, id long, fingerprint array<int>")
    distinct, copies = similarity.collapse_copies(nodes)
    assert distinct.count() == 11
    assert {(r["src"], r["dst"]) for r in copies.collect()} == {(0, i) for i in range(1, 50)}


def kruskal(edges):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    chosen = set()
    for dist, src, dst in sorted(edges):
        a, b = find(src), find(dst)
        if a != b:
            parent[a] = b
            chosen.add((src, dst))
    return chosen


@pytest.mark.parametrize("hot_keys", [10_000, 5])
def test_spanning_forest_against_kruskal(spark, monkeypatch, hot_keys):
    monkeypatch.setattr(spanning_tree, "MAX_HOT_KEYS", hot_keys)
    monkeypatch.setattr(lookup, "MAX_HOT_KEYS", hot_keys)
    rng = random.Random(9)
    rows = []
    for d in ("a", "b"):
        seen = set()
        # A hub that touches a third of all edges, and many equal distances.
        while len(seen) < 150:
            a, b = (0, rng.randrange(1, 60)) if rng.random() < 0.34 else (rng.randrange(80), rng.randrange(80))
            if a != b:
                seen.add((min(a, b), max(a, b)))
        rows += [(d, a, b, float(rng.randrange(5))) for a, b in seen]
    df = spark.createDataFrame(rows, "dataset_id string, src long, dst long, dist double")
    got = spanning_tree.spanning_forest(df).collect()
    for d in ("a", "b"):
        want = kruskal([(w, a, b) for x, a, b, w in rows if x == d])
        assert {(r["src"], r["dst"]) for r in got if r["dataset_id"] == d} == want


def test_fingerprint_names():
    slots = {"ECFP4": KERNEL.fingerprint}
    assert similarity.named_fingerprint(slots, "ECFP4") is KERNEL.fingerprint
    with pytest.raises(ValueError, match="No fingerprint"):
        similarity.named_fingerprint(slots, "ecfp4")


def test_empty_sets_have_no_signature(spark):
    df = spark.createDataFrame([([],), ([5],), ([],)], "f array<int>")
    got = [r[0] for r in df.select(similarity.signature(F.col("f"), 4)).collect()]
    assert got[0] == got[2] == [similarity.PRIME] * 4 and max(got[1]) < similarity.PRIME


def test_short_texts_are_nodes(spark):
    df = spark.createDataFrame([("C",), (" CCO ",), ("[Pd]",)], "smiles string")
    assert similarity.split_valid(df, KERNEL)[0].count() == 3


def test_no_valid_rows(spark):
    df = spark.createDataFrame([("not valid",), ("",)], "smiles string")
    valid, invalid = similarity.split_valid(df, KERNEL)
    assert invalid.count() == 2
    with pytest.raises(RuntimeError, match="Every row is invalid"):
        similarity.require_valid(valid)


# --- Prediction -----------------------------------------------------------------------------


def test_prediction_touches_only_the_text(spark):
    df = spark.createDataFrame([("C", 9007199254740993), ("CC", None)], "smiles string, n long")
    load = lambda: lambda texts: pd.DataFrame({"y": texts.str.len()})
    got = predict.predict(df, load, ["y"]).collect()
    assert [tuple(r) for r in got] == [("C", 9007199254740993, "1"), ("CC", None, "2")]
    with pytest.raises(ValueError, match="no rows"):
        predict.predict(df.limit(0), load, ["y"])


def test_unconfigured_prediction(spark):
    df = spark.createDataFrame([("C",)], "smiles string")
    with pytest.raises(predict.PredictorNotConfigured):
        predict.predict(df, None, ["y"])


def test_fewer_predictions_than_rows(spark):
    rows = spark.createDataFrame([(1, "C"), (2, "CC"), (3, "CCC")], "i int, smiles string")
    found = spark.createDataFrame([(1, 0.5), (2, 1.5)], "i int, y double")
    got = predict.merge_predictions(rows, found, ["i"]).orderBy("i").collect()
    assert [(r["i"], r["chemprop_prediction"]) for r in got] == [(1, "0.5"), (2, "1.5")]


def _brute_bits(text, q):
    grams = [text] if len(text) < q else [text[i : i + q] for i in range(len(text) - q + 1)]
    return sorted({int(hashlib.md5(g.encode()).hexdigest()[:8], 16) % 2048 for g in grams})


@pytest.mark.parametrize("name, q", [("qgram", 4), ("bigram", 2)])
def test_portable_fingerprints_by_batches(spark, name, q):
    """Grams are those of the code points, also beyond the first plane, and never run over two texts."""
    texts = ["a", "abc", "abcd", "x😀abcd", "😀😃", "é中文 \n x" * 9, "abcab" * 500, "", None]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string").coalesce(1)
    got = df.select("id", text_kernel(portable=True).fingerprints[name](F.col("text"))).collect()
    assert {i: f for i, f in got} == {i: _brute_bits(t, q) if t else None for i, t in enumerate(texts)}


def test_each_gram_is_hashed_once(monkeypatch):
    hashed = []
    monkeypatch.setattr(kernel.hashlib, "md5", lambda g, **_: hashed.append(g) or hashlib.sha256(g))
    known = {}
    for texts in (["abcdabcdab", "abcdab"], ["abcd"]):
        kernel._on_bits(texts, 4, 2048, known)
    assert sorted(hashed) == [b"abcd", b"bcda", b"cdab", b"dabc"]


def test_each_bit_is_hashed_once_in_blocks(monkeypatch):
    rng = np.random.default_rng(5)
    sets = [np.sort(rng.choice(700, n, replace=False)).astype(np.int32) for n in (0, 1, 300, 0, 12, 699, 0)]
    parameters = np.array(similarity.hash_parameters(8), dtype=np.int64)
    want = [[min(((a * int(x) + b) % similarity.PRIME for x in s), default=similarity.PRIME) for a, b in parameters.tolist()] for s in sets]
    for at_once, known in ((1024, 4096), (2, 50), (1, 699)):
        monkeypatch.setattr(similarity, "SETS_AT_ONCE", at_once)
        monkeypatch.setattr(similarity, "BITS_AT_ONCE", known)
        assert similarity._minima(sets, parameters).tolist() == want


def test_nearest_neighbours_work_distances_out_once(spark):
    counted = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def counting(x):
        counted.add(1)
        return x

    rows = [("d", 1, 2, 0.5), ("d", 1, 3, 0.2), ("d", 2, 3, 0.2)]
    pairs = spark.createDataFrame(rows, "dataset_id string, src long, dst long, dist double")
    near = similarity.nearest_neighbours(pairs.withColumn("dist", counting("dist").alias("dist")), 1).collect()
    assert {(r["id"], r["neighbour"], r["rank"]) for r in near} == {(1, 3, 1), (2, 3, 1), (3, 1, 1)}
    assert counted.value == len(rows)


def test_block_sums_leave_a_task_once_per_point_and_cluster():
    rng = np.random.default_rng(8)
    x, labels = rng.normal(size=(40, 3)), rng.integers(0, 3, 40)
    blocks = [dict(dataset_id="d", block=b, rep=list(range(b * 10, b * 10 + 10)), cluster=labels[b * 10 : b * 10 + 10].tolist(),
                   weight=[1 + i % 2 for i in range(10)], x=x[b * 10 : b * 10 + 10].ravel()) for b in range(4)]
    met = [a | {f"{c}_r": b[c] for c in ("cluster", "weight", "x")} for a in blocks for b in blocks]
    found = pd.concat(silhouette._block_sums(3)(iter([pd.DataFrame(met[:7]), pd.DataFrame(met[7:])])))
    assert len(found) == 40 * 3
    weights = np.array([1 + i % 2 for i in range(40)])
    for r in found.itertuples():
        to = labels == r.to_cluster
        want = (np.sqrt(((x[r._2] - x[to]) ** 2).sum(1)) * weights[to]).sum()
        assert math.isclose(r.total, want, rel_tol=1e-12)


def test_points_are_not_shuffled_to_their_statistics(spark):
    points = spark.range(1000).selectExpr("string(id % 3) AS dataset_id", "id AS point_id", "double(id) AS x", "int(id % 2) AS cluster")
    plan = clustering.standardise(points, ["x"])._jdf.queryExecution().optimizedPlan().toString()
    executed = clustering.standardise(points, ["x"])._jdf.queryExecution().executedPlan().toString()
    assert "Join" in plan and "BroadcastHashJoin" in executed and "SortMergeJoin" not in executed


def test_distance_of_sets_made_after_the_join(spark):
    nodes = spark.createDataFrame([("d", 1, "abcdef"), ("d", 2, "abcdxy"), ("d", 3, ""), ("d", 4, "ab"), ("d", 5, None)],
                                  "dataset_id string, id long, fingerprint string")
    pairs = spark.createDataFrame([("d", 1, 2), ("d", 2, 3), ("d", 3, 4), ("d", 3, 3), ("d", 4, 5)], "dataset_id string, src long, dst long")
    made = similarity.jaccard_distance(pairs, nodes, bits=None, sets_of=kernel.qgrams)
    held = nodes.withColumn("fingerprint", kernel.qgrams(F.col("fingerprint")))
    want = similarity.jaccard_distance(pairs, held, bits=None)
    assert sorted(map(tuple, made.collect())) == sorted(map(tuple, want.collect()))
    assert "regexp_extract_all" not in made._jdf.queryExecution().optimizedPlan().toString().split("Join")[-1]


def test_copies_meet_by_digest(spark):
    rows = [("d", i, [1, 2, 3] if i % 3 else [i]) for i in range(30)] + [("d", 100, None), ("d", 101, None), ("d", 102, []), ("d", 103, [])]
    nodes = spark.createDataFrame(rows, "dataset_id string, id long, fingerprint array<int>")
    _, edges = similarity.collapse_copies(nodes)
    assert {(r["src"], r["dst"]) for r in edges.collect()} == {(1, i) for i in range(2, 30) if i % 3} | {(102, 103)}
    joined = [line for line in edges._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join" in line]
    assert joined and all("fingerprint" not in line for line in joined)
