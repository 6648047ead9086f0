"""Products through their factors, against the attempts themselves."""

import dataclasses
import random

import pytest
from pyspark.sql import functions as F

from molspark.functions.kernel import TEXT_DESCRIPTORS, text_kernel
from molspark.operators import descriptors, factorised
from molspark.operators import enumerate as library
from molspark.session import materialised

KERNEL = text_kernel()
PLAIN = dataclasses.replace(KERNEL, additive=None)
MANY = 1_000_000


def tables(spark, seed, dotted=False):
    """Datasets of one to three labels with repeated, unjoinable and oddly marked parts."""
    rng = random.Random(seed)
    bodies = ["C", "CC", "N", "c1ccccc1", "O=C(C)", "[NH3+]", "Cl", "C1CC1"]
    scaffolds, groups = [], []
    for d, labels in (("one", 1), ("two", 2), ("three", 3), ("none", 2), ("lost", 2)):
        for i in range(14):
            points = "".join(f"C([*:{k}])" for k in range(1, labels + 1))
            scaffold = points + rng.choice(bodies)
            if rng.random() < 0.2:
                scaffold = rng.choice(["", " ", "BAD!", "C[*:1]C[*:2]C[*:3]C[*:4]", points.replace("[*:1]", "*")])
            scaffolds.append((d, 100 - i, scaffold))
        for k in range(1, labels + 1):
            for pos in range(rng.randint(3, 9)):
                body = rng.choice(bodies) if d != "lost" or k == 1 else "*"
                mark = k if rng.random() < 0.9 else rng.choice([1, 2, 3])
                tail = ".N" if dotted and rng.random() < 0.3 else ""
                text = f"[*:{mark}]C{body}{tail}" if body != "*" else "C*"
                groups.append((d, f"R{k}", 7 * pos + k, text))
    if dotted:
        # Two ways to the same product: scaffold and fragment share out the parts differently.
        scaffolds += [("dots", 1, "C[*:1].O"), ("dots", 2, "C[*:1]")]
        groups += [("dots", "R1", 0, "N[*:1]"), ("dots", "R1", 1, "O.N[*:1]"), ("dots", "R1", 2, "N[*:1]")]
    groups = [g for g in groups if g[0] != "none"]
    return (
        spark.createDataFrame(scaffolds, "dataset_id string, scaffold_id long, smiles string"),
        spark.createDataFrame(groups, "dataset_id string, label string, pos long, smiles string"),
    )


def rows(df):
    return sorted(map(str, (tuple(r) for r in df.collect())))


@pytest.mark.parametrize("dotted", [False, True])
def test_library_equals_attempts(spark, dotted):
    scaffolds, groups = tables(spark, 5, dotted)
    columns = ["dataset_id", "scaffold_id", "ord", "smiles", "r_groups"]
    wanted = materialised(library.capped_library(scaffolds, groups, KERNEL, MANY).select(*columns))
    got = factorised.enumerate_library(scaffolds, groups, KERNEL).select(*wanted.columns)
    assert rows(got) == rows(wanted) and wanted.count() > 100
    described = descriptors.with_descriptors(wanted, KERNEL).drop("r_groups")
    mine = factorised.described_library(scaffolds, groups, KERNEL).select(*described.columns)
    assert rows(mine) == rows(described)
    if dotted:
        assert rows(got.where("dataset_id = 'dots'")) != []


def test_library_of_a_plain_kernel(spark):
    scaffolds, groups = tables(spark, 8)
    got = factorised.described_library(scaffolds, groups, PLAIN)
    assert rows(got) == rows(factorised.described_library(scaffolds, groups, KERNEL).select(*got.columns))
    assert rows(factorised.attempt_counts(scaffolds, groups, PLAIN)) == rows(factorised.attempt_counts(scaffolds, groups, KERNEL))


def test_counts_equal_attempts(spark):
    scaffolds, groups = tables(spark, 6)
    made = library.attempts(scaffolds, groups, KERNEL)
    assert rows(factorised.attempt_counts(scaffolds, groups, KERNEL)) == rows(library.enumeration_stats(made))
    assert factorised.attempt_counts(scaffolds.limit(0), groups, KERNEL).collect() == []
    assert factorised.attempt_counts(scaffolds, groups.limit(0), KERNEL).collect() == []


def test_many_combinations_are_only_counted(spark):
    """Far more products than could be made: 600 fragments under each of six labels."""
    scaffolds = spark.createDataFrame([("d", 1, "".join(f"C([*:{k}])" for k in range(1, 7)))], "dataset_id string, scaffold_id long, smiles string")
    pos = spark.range(600).select(F.col("id").alias("pos"), F.explode(F.sequence(F.lit(1), F.lit(6))).alias("k"))
    groups = pos.select(
        F.lit("d").alias("dataset_id"), F.concat(F.lit("R"), "k").alias("label"), "pos",
        F.concat(F.lit("[*:"), "k", F.lit("]C"), F.expr("repeat('C', cast(pos % 7 as int))"), F.when(F.col("pos") % 2 == 0, "F").otherwise("")).alias("smiles"),
    )
    stats = factorised.attempt_counts(scaffolds, groups, KERNEL).first()
    assert (stats.attempted, stats.valid, stats.skipped) == (600**6, 600**6, 0)
    moments = factorised.product_moments(scaffolds, groups, KERNEL).first()
    assert moments.n == 14**6
    # Six scaffold atoms; each fragment has 1 to 7 carbons, and a fluorine or none.
    assert moments.mean_n_heavy_atoms == pytest.approx(6 + 6 * (4 + 0.5))
    assert moments.std_n_heavy_atoms == pytest.approx((6 * (4 + 0.25)) ** 0.5)
    assert moments.mean_n_rings == pytest.approx(0, abs=1e-12) and moments.std_n_rings == 0


@pytest.mark.parametrize("dotted", [False, True])
def test_moments_equal_products(spark, dotted):
    scaffolds, groups = tables(spark, 7, dotted)
    made = materialised(library.capped_library(scaffolds, groups, KERNEL, MANY))
    described = descriptors.with_descriptors(made, KERNEL)
    want = {
        r.dataset_id: r
        for r in described.groupBy("dataset_id").agg(
            F.count(F.lit(1)).alias("n"),
            *(F.avg(c).alias(f"mean_{c}") for c in TEXT_DESCRIPTORS),
            *(F.stddev_pop(c).alias(f"std_{c}") for c in TEXT_DESCRIPTORS),
        ).collect()
    }
    got = {r.dataset_id: r for r in factorised.product_moments(scaffolds, groups, KERNEL).collect()}
    assert set(got) == set(want)
    for d, r in got.items():
        assert r.n == want[d].n
        for c in TEXT_DESCRIPTORS:
            assert r[f"mean_{c}"] == pytest.approx(want[d][f"mean_{c}"], abs=1e-9)
            assert r[f"std_{c}"] == pytest.approx(want[d][f"std_{c}"], abs=1e-7)


def test_products_are_not_regrouped(spark):
    """Separable parts: nothing after the decoding of the chunks sorts, groups or shuffles products."""
    scaffolds, groups = tables(spark, 9)
    made = factorised.described_library(scaffolds, groups, KERNEL)
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    above = plan[: plan.index("Generate inline")]
    assert "Aggregate" not in above and "Join" not in above and "Sort" not in above and "regexp" not in above
