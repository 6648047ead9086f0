"""Whole runs over CSV pairs on disk."""

import csv

import pandas as pd
import pytest

from molspark.plans.run import RunConfig, current, process_datasets, published, remove_unused

SCAFFOLDS = ["c1ccccc1[*:1]", "C1CCCCC1[*:1]", "c1ccncc1[*:1]"]
FRAGMENTS = ["[*:1]C", "[*:1]CC", "[*:1]CCC", "[*:1]N", "[*:1]NC", "[*:1]O", "[*:1]OC", "[*:1]F", "[*:1]Cl"]


def write(path, header, rows):
    path.parent.mkdir(parents=True, exist_ok=True)
    with open(path, "w", newline="") as fh:
        csv.writer(fh).writerows([header, *rows])


def length_model():
    def load():
        return lambda texts: pd.DataFrame({"prediction": texts.str.len()})

    return load


@pytest.fixture(scope="module")
def base(tmp_path_factory):
    root = tmp_path_factory.mktemp("bucket")
    write(root / "demo_scaffolds.csv", [" SMILES "], [[s] for s in SCAFFOLDS])
    write(root / "demo_r_groups.csv", ["R1"], [[f] for f in FRAGMENTS])
    # Two labels, one unusable row, one scaffold of the wrong arity, a path in the id.
    write(
        root / "team/two_scaffolds.csv",
        ["name", "smiles"],
        [["a", "[*:1]Cc1ccc([*:2])cc1"], ["b", "CC[*:1]"], ["c", ""], ["d", "[*:1]CCCC[*:2]"]],
    )
    write(
        root / "team/two_r_groups.csv",
        ["R2", "R1"],
        [["[*:2]F", "[*:1]C"], ["[*:2]Cl", "[*:1]CC"], ["", "[*:1]O"], ["[*:2]Br", "[*:1]N"], ["[*:2]I", "[*:1]S"]],
    )
    write(root / "bad_scaffolds.csv", ["smiles"], [["NOT_A_MOLECULE"], ["c1ccccc1[*:1]"]])
    write(root / "bad_r_groups.csv", ["R1"], [[f] for f in FRAGMENTS])
    write(root / "few_scaffolds.csv", ["smiles"], [["c1ccccc1[*:1]"]])
    write(root / "few_r_groups.csv", ["R1"], [["[*:1]C"]])
    write(root / "alone_scaffolds.csv", ["smiles"], [["c1ccccc1[*:1]"]])
    return root


def test_run(spark, base, tmp_path):
    out = str(tmp_path / "out")
    config = RunConfig(str(base), out, n_clusters=3, predictor=length_model(), graph={"trees": 4})
    tables = process_datasets(spark, config)

    verdicts = {r["dataset_id"]: r["passed"] for r in tables["run_datasets"].collect()}
    assert verdicts == {"demo": True, "team/two": True, "bad": False, "few": False}
    failed = {r["dataset_id"]: r["stage"] for r in tables["failures"].collect()}
    assert failed == {"bad": "scaffold_validity", "few": "cluster_count"}

    clusters = tables["clusters"].toPandas()
    sizes = clusters.groupby("dataset_id").size().to_dict()
    assert sizes == {"demo": 27, "team/two": 32}
    assert set(clusters["cluster"]) == {0, 1, 2}
    demo = clusters[clusters["dataset_id"] == "demo"].sort_values(["scaffold_id", "ord"])
    assert demo["smiles"].iloc[0] == "c1ccccc1-%91.C-%91"
    assert demo["smiles"].nunique() == 27
    assert [r["R1"] for r in demo["r_groups"]] == FRAGMENTS * 3
    two = clusters[clusters["dataset_id"] == "team/two"].sort_values(["scaffold_id", "ord"])
    # Labels in lexical order whatever the column order; the last label moves fastest.
    assert [(r["R1"], r["R2"]) for r in two["r_groups"]][:5] == [
        ("[*:1]C", "[*:2]F"), ("[*:1]C", "[*:2]Cl"), ("[*:1]C", "[*:2]Br"), ("[*:1]C", "[*:2]I"),
        ("[*:1]CC", "[*:2]F"),
    ]

    made = {r["dataset_id"]: (r["attempted"], r["valid"], r["skipped"], r["possible"]) for r in tables["generation_stats"].collect()}
    assert made == {"demo": (27, 27, 0, 27), "team/two": (32, 32, 0, 32), "few": (1, 1, 0, 1)}
    wrong = [(r["dataset_id"], r["smiles"], r["n_points"], r["n_labels"]) for r in tables["skipped_scaffolds"].collect()]
    assert wrong == [("team/two", "CC[*:1]", 1, 2)]

    edges = tables["edges"].toPandas()
    nodes = tables["nodes"].toPandas()
    assert len(nodes) == 59
    tree = edges[edges["in_tree"]]
    assert tree.groupby("dataset_id").size().max() <= 31
    predictions = tables["predictions"].toPandas()
    assert (predictions["chemprop_prediction"] == predictions["smiles"].str.len().astype(str)).all()

    # A second run finds only the failed ones; overwriting takes all again.
    assert {r[0] for r in published(spark, out).collect()} == {"demo", "team/two"}
    again = process_datasets(spark, RunConfig(str(base), out, n_clusters=3, with_graph=False, run_id="2"))
    assert {r["dataset_id"] for r in again["run_datasets"].collect()} == {"bad", "few"}
    assert {r["dataset_id"] for r in again["skipped"].collect()} == {"demo", "team/two"}
    one = process_datasets(
        spark, RunConfig(str(base), out, dataset_id="demo", overwrite=True, n_clusters=2, with_graph=False, run_id="3")
    )
    assert [r["dataset_id"] for r in one["run_datasets"].collect()] == ["demo"]
    assert {r[0] for r in published(spark, out).collect()} == {"demo", "team/two"}


def test_missing_pair_is_reported(spark, base, tmp_path):
    config = RunConfig(str(base), str(tmp_path / "out"), dataset_id="alone", with_graph=False)
    tables = process_datasets(spark, config)
    row = tables["failures"].collect()[0]
    assert (row["dataset_id"], row["stage"]) == ("alone", "inputs_present")


def test_failures_stay_with_their_dataset(spark, tmp_path):
    """Odd atoms, odd ids and empty files; and a second run leaves no rows of the first."""
    root, out = tmp_path / "in", str(tmp_path / "out")
    for name in ("good", "a[1]", "metal"):
        first = "C[Pd][*:1]" if name == "metal" else "c1ccccc1[*:1]"
        write(root / f"{name}_scaffolds.csv", ["smiles"], [[first], *[[s] for s in SCAFFOLDS[1:]]])
        write(root / f"{name}_r_groups.csv", ["R1"], [[f] for f in FRAGMENTS])
    (root / "empty_scaffolds.csv").write_text("")
    write(root / "empty_r_groups.csv", ["R1"], [["[*:1]C"]])
    config = RunConfig(str(root), out, n_clusters=2, with_graph=False, predictor=length_model(), log_base="http://logs")
    tables = process_datasets(spark, config)
    verdicts = {r["dataset_id"]: r["passed"] for r in tables["run_datasets"].collect()}
    assert verdicts == {"good": True, "a[1]": True, "metal": True, "empty": False}
    assert tables["failures"].head()["log_url"] == "http://logs/run/scaffold_validity/empty"
    assert tables["clusters"].where("dataset_id = 'a[1]'").count() == 27
    write(root / "good_scaffolds.csv", ["smiles"], [["NOT_A_MOLECULE"]])
    again = process_datasets(
        spark, RunConfig(str(root), out, dataset_id="good", overwrite=True, with_graph=False, run_id="2")
    )
    assert again["clusters"].where("dataset_id = 'good'").count() == 0
    assert again["clusters"].where("dataset_id = 'metal'").count() == 27
    assert {r[0] for r in published(spark, out).collect()} == {"a[1]", "metal"}


def test_a_broken_run_leaves_the_old_result(spark, tmp_path):
    root, out = tmp_path / "in", str(tmp_path / "out")
    write(root / "x_scaffolds.csv", ["smiles"], [[s] for s in SCAFFOLDS])
    write(root / "x_r_groups.csv", ["R1"], [[f] for f in FRAGMENTS])
    plain = {"n_clusters": 2, "with_graph": False, "min_products": 1}
    process_datasets(spark, RunConfig(str(root), out, **plain))
    before = sorted(r["smiles"] for r in current(spark, out, "clusters").collect())
    write(root / "x_scaffolds.csv", ["smiles"], [[s] for s in SCAFFOLDS[:2]])

    def broken():
        raise RuntimeError("no model")

    with pytest.raises(Exception, match="no model"):
        process_datasets(spark, RunConfig(str(root), out, overwrite=True, predictor=broken, **plain))
    # Its clusters are written, but nothing points at them.
    assert sorted(r["smiles"] for r in current(spark, out, "clusters").collect()) == before
    assert len(before) == 27 and [r[0] for r in published(spark, out).collect()] == ["x"]
    process_datasets(spark, RunConfig(str(root), out, overwrite=True, max_products=5, **plain))
    assert current(spark, out, "clusters").count() == 10
    gone = remove_unused(spark, out)
    assert len(gone) >= 6 and current(spark, out, "clusters").count() == 10


def test_no_new_datasets(spark, tmp_path):
    write(tmp_path / "in" / "x_scaffolds.csv", ["smiles"], [["C"]])
    tables = process_datasets(spark, RunConfig(str(tmp_path / "in"), str(tmp_path / "out"), with_graph=False))
    assert tables["run_summary"].head()["headline"] == "There was nothing new to run."
