"""Exact and near copies, line passages and benchmark items against brute force."""

import hashlib
import itertools
import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from molspark.llm import components, decontaminate, exact_dedup, line_dedup, queries, simhash


def rows_of(df):
    return [tuple(r) for r in df.collect()]


def flat(text):
    out, space = [], False
    for c in text or "":
        if c in " \t\n\v\f\r":
            if not space:
                out.append(" ")
            space = True
        else:
            out.append(c)
            space = False
    return "".join(out)


@pytest.mark.parametrize("heavy", [1, 2, 1024])
def test_exact_groups(odd_docs, heavy):
    got = rows_of(exact_dedup.exact_groups(odd_docs, heavy=heavy))
    docs = [(r.doc_id, flat(r.text)) for r in odd_docs.select("doc_id", "text").collect()]
    groups = defaultdict(list)
    for i, t in docs:
        groups[t].append(i)
    want = Counter()
    for i, t in docs:
        known = [x for x in groups[t] if x is not None]
        want[i, min(known, default=None), len(groups[t]), hashlib.sha256(t.encode()).hexdigest()] += 1
    assert Counter((i, k, n, s) for i, k, n, _, s in got) == want
    kept = Counter(s for *_, k, s in got if k)
    assert kept == Counter({hashlib.sha256(t.encode()).hexdigest(): 1 for t in groups})
    assert all(i == k for i, k, _, stays, _ in got if stays)


@pytest.mark.parametrize("heavy", [1, 1024])
def test_drop_exact_copies(odd_docs, heavy):
    left = exact_dedup.drop_exact_copies(odd_docs, heavy=heavy)
    assert left.columns == odd_docs.columns
    texts = [flat(r.text) for r in left.collect()]
    assert sorted(texts) == sorted({flat(r.text) for r in odd_docs.collect()})
    assert 1 in [r.doc_id for r in left.collect()] and 2 not in [r.doc_id for r in left.collect()]


def test_exact_empty(no_docs):
    assert exact_dedup.exact_groups(no_docs).collect() == []
    assert exact_dedup.drop_exact_copies(no_docs).collect() == []


def words(text):
    return [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in flat(text)).split(" ") if w]


def brute_fingerprint(text, size=3):
    w = words(text)
    if not w:
        return 0
    grams = [" ".join(w[i : i + size]) for i in range(len(w) - size + 1)] or [" ".join(w)]
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def brute_components(fps, radius):
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(range(len(fps)), 2):
        if (fps[a][1] ^ fps[b][1]).bit_count() <= radius:
            root[find(a)] = find(b)
    groups = defaultdict(list)
    for i in range(len(fps)):
        groups[find(i)].append(fps[i][0])
    return [(d, f"{f:016x}", min((x for x in groups[find(i)] if x is not None), default=None)) for i, (d, f) in enumerate(fps)]


def test_simhash(spark, sf, odd_docs):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    docs = docs.unionByName(odd_docs.select((F.col("doc_id") + 10_000).alias("doc_id"), "text"))
    fps = [(r.doc_id, brute_fingerprint(r.text)) for r in docs.collect()]
    got = rows_of(simhash.near_components(docs))
    assert Counter(got) == Counter(brute_components(fps, 3))


def test_simhash_steps_cover_all_links():
    rng = random.Random(3)
    _, steps = None, {s for s in itertools.product(range(-3, 4), repeat=4) if sum(map(abs, s)) <= 3}
    for _ in range(2000):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), rng.randint(0, 3)):
            b ^= 1 << bit
        d = tuple((a >> 16 * i & 0xFFFF).bit_count() - (b >> 16 * i & 0xFFFF).bit_count() for i in range(4))
        assert d in steps


def test_simhash_of_changed_copies(spark):
    """Fingerprints one to six bits apart, in chains: linked exactly as by brute force."""
    rng = random.Random(5)
    fps = []
    for _ in range(40):
        f = rng.getrandbits(64)
        for _ in range(rng.randint(1, 12)):
            fps.append((len(fps), f))
            for bit in rng.sample(range(64), rng.randint(0, 6)):
                f ^= 1 << bit
    signed = lambda f: f - (1 << 64) if f >> 63 else f
    rows = spark.createDataFrame([(i, [signed(f)]) for i, f in fps], "doc_id long, fp array<long>")
    found = simhash._with_component(rows, *simhash.linked_classes(rows, 1, 3, parts=4))
    got = {r.doc_id: r.component_id for r in found.collect()}
    assert got == {d: c for d, _, c in brute_components(fps, 3)}
    coarse = simhash._with_component(rows, *simhash.linked_classes(rows, 1, 6))
    assert {r.doc_id: r.component_id for r in coarse.collect()} == {d: c for d, _, c in brute_components(fps, 6)}


def test_stars_keep_components():
    rng = np.random.default_rng(1)
    a, b = rng.integers(0, 60, 50), rng.integers(0, 60, 50)
    x, y = simhash.stars(a, b)
    assert len(x) <= 59

    def parts(p, q):
        label = {n: n for n in range(60)}
        for _ in range(60):
            for s, t in zip(p, q):
                label[s] = label[t] = min(label[s], label[t])
        return label

    assert parts(a, b) == parts(x, y)


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)]
    star = [(100, 200 + i) for i in range(50)]
    edges = spark.createDataFrame([*chain, *star, (7, 7), (None, 3)], "a long, b long")
    got = {r.node: r.root for r in components.components(edges).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, **{200 + i: 100 for i in range(50)}}
    assert components.components(edges.limit(0)).collect() == []


def changed(text, share, rng):
    w = text.split()
    for i in rng.sample(range(len(w)), int(len(w) * share)):
        w[i] = f"new{rng.randint(0, 10**9)}"
    return " ".join(w)


def test_drop_near_copies(spark, sf, odd_docs):
    """Of each component of the operator's own contract the smallest doc_id stays, whatever its size."""
    rng = random.Random(2)
    base = [" ".join(f"w{rng.randint(0, 50_000)}" for _ in range(300)) for _ in range(30)]
    rows = [(i, t) for i, t in enumerate(base)] + [(100 + i, changed(t, 0.004, rng)) for i, t in enumerate(base)]
    rows += [(200 + i, changed(base[0], 0.5, rng)) for i in range(30)] + [(1000 + i, base[1]) for i in range(300)]
    rows += [(2000 + r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    left = simhash.drop_near_copies(spark.createDataFrame(rows, "doc_id long, text string"))
    ids = [r.doc_id for r in left.collect()]
    want = {c for _, _, c in brute_components([(d, brute_fingerprint(t)) for d, t in rows], 3)}
    assert len(ids) == len(set(ids)) and set(ids) == want
    assert want >= set(range(30)) | {200 + i for i in range(30)} and not want & set(range(1000, 1300))

    odd = simhash.drop_near_copies(odd_docs)
    assert odd.columns == odd_docs.columns
    kept = [(r.doc_id, r.text is None or not r.text.strip()) for r in odd.collect()]
    assert {d for d, blank in kept if not blank} == {1, 6, 8, 9} and sum(b for _, b in kept) == 1
    assert len([d for d, _ in kept if d == 8]) == 2
    twice = spark.createDataFrame([(5, "a b c d", 1), (5, "a b c d", 2), (6, "a b c d", 3)], "doc_id long, text string, _key int")
    assert [r.doc_id for r in simhash.drop_near_copies(twice).collect()] == [5]


def test_near_empty(no_docs):
    assert simhash.near_components(no_docs).collect() == []
    assert simhash.drop_near_copies(no_docs).collect() == []


def grams(text, size):
    w = words(text)
    return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)}


def brute_items(docs, items):
    out = []
    for d, text in docs:
        for i, item in items:
            size = min(5, len(words(item)))
            own = grams(item, size) if size else set()
            shared = len(own & grams(text, size)) if own else 0
            if own and shared >= math.ceil(0.8 * len(own) - 1e-9):
                out.append((d, i, shared, len(own)))
    return Counter(out)


def test_contained_items(spark, sf, odd_docs):
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    rng = random.Random(2)
    for n, (_, t) in enumerate(bench[:12]):
        w = t.split()
        w[rng.randrange(len(w))] = "other"
        docs.append((5000 + n, f"before it {' '.join(w)} after it"))
        docs.append((6000 + n, " ".join(w[: len(w) // 2])))
    docs += [(r.doc_id, r.text) for r in odd_docs.collect()]
    bench += [(900, "same text"), (901, None), (902, "  "), (903, "the same text here and there"), (903, "one"), (None, "another text")]
    made = lambda rows, names: spark.createDataFrame(rows, names)
    items = made(bench, "item_id long, text string").withColumn("doc_id", F.lit("x"))
    for block in (16_000_000, 2_000):
        got = decontaminate.contained_items(made(docs, "doc_id long, text string"), items, block_bytes=block)
        assert Counter((r.doc_id, r.item_id, r.shared, r.shingles) for r in got.collect()) == brute_items(docs, bench)


def test_drop_contaminated(spark, odd_docs, no_docs):
    items = spark.createDataFrame([(1, "same text here"), (2, None)], "item_id long, text string")
    left = decontaminate.drop_contaminated(odd_docs, items)
    assert left.columns == odd_docs.columns
    assert sorted(r.doc_id or 0 for r in left.collect()) == [0, 3, 4, 5, 6, 7, 8, 8, 9]
    assert decontaminate.drop_contaminated(odd_docs, items.limit(0)).count() == odd_docs.count()
    assert decontaminate.contained_items(no_docs, items).collect() == []


def passage(n, rng):
    return [f"line {n} {i} " + " ".join(f"p{rng.randint(0, 999)}" for _ in range(12)) for i in range(6)]


def test_line_dedup(spark):
    rng = random.Random(4)
    shared = [passage(n, rng) for n in range(5)]
    rows, clean = [], {}
    for d in range(40):
        lines = [f"own {d} {i} {rng.random()}" for i in range(6)]
        at = rng.randint(0, 6)
        rows.append((d, "\n".join(lines[:at] + shared[d % 5] + lines[at:])))
        clean[d] = "\n".join(lines)
    rows += [(100, "alone\nand\nby itself"), (101, "x"), (102, None), (103, ""), (None, "\n".join(shared[0]))]
    long_line = " ".join(f"l{i}" for i in range(60))
    rows += [(110, f"a1\n{long_line}\nb1"), (111, f"a2\n{long_line}\nb2\n")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("_removed", F.lit(1)).withColumn("th", F.lit(2))
    got = line_dedup.drop_repeated_passages(docs)
    assert got.columns == docs.columns
    texts = {r.doc_id: r.text for r in got.collect()}
    for d in range(5):
        assert texts[d] == rows[d][1]
    for d in range(5, 40):
        assert texts[d] == clean[d]
    assert texts[100] == "alone\nand\nby itself" and texts[101] == "x" and texts[102] is None and texts[103] == ""
    assert texts[None] == ""
    assert texts[110] == rows[-2][1] and texts[111] == "a2\nb2\n"


def lines_that_go(rows, long_words=line_dedup.LONG_WORDS):
    """Per document the numbers of lines whose pair with a neighbour, or who if long, stand earlier."""
    seen, out = set(), {}
    for d, text in sorted(rows):
        lines = text.split("\n")
        full = [i for i, line in enumerate(lines) if line.strip(" ")]
        gone = set()
        for a, b in itertools.pairwise(full):
            if (lines[a], lines[b]) in seen:
                gone |= set(range(a, b + 1))
            seen.add((lines[a], lines[b]))
        for i in full:
            if len(lines[i].split()) >= long_words:
                if lines[i] in seen:
                    gone.add(i)
                seen.add(lines[i])
        out[d] = gone
    return out


def test_line_dedup_brute_force(spark):
    """Nested passages, parts of copies, paragraphs between blank lines, and repeats inside a document."""
    rng = random.Random(8)
    x, y = [f"x{i} " * 5 for i in range(5)], [f"y{i} " * 5 for i in range(8)]
    rows = [(1, x + y), (2, ["two"] + x + y), (3, ["three"] + y[1:5] + ["end"]), (4, ["four"] + y[3:5]), (5, y[2:4] + ["five"])]
    rows += [(6, ["p6", "", y[0], "", "  ", y[1], "", y[2], "q6"]), (7, ["p7", "", y[0], "", "q7"]), (8, ["a", "b", "a", "b", "a", "b"])]
    for d in range(20, 80):
        lines = [f"own {d} {i}" for i in range(rng.randint(0, 4))]
        for _ in range(rng.randint(1, 4)):
            source = rng.choice(rows)[1]
            a = rng.randrange(len(source))
            at = rng.randint(0, len(lines))
            lines[at:at] = source[a : a + rng.randint(1, 7)]
        rows.append((d, lines))
    rows = [(d, "\n".join(lines)) for d, lines in rows]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in line_dedup.drop_repeated_passages(docs, removed="gone").collect()}
    for d, gone in lines_that_go(rows).items():
        assert {i for first, last in got[d].gone for i in range(first, last + 1)} == gone, d
        lines = dict(rows)[d].split("\n")
        assert got[d].text == "\n".join(line for i, line in enumerate(lines) if i not in gone)


def test_line_dedup_on_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    want = lines_that_go([(r.doc_id, r.text) for r in docs.collect()])
    for r in line_dedup.drop_repeated_passages(docs, removed="gone").collect():
        assert {i for first, last in r.gone for i in range(first, last + 1)} == want[r.doc_id]


def test_line_dedup_many_lines(spark):
    """Documents of very many lines with a shared passage every few lines."""
    rows = [(d, "\n".join(f"shared {i} of all" if i % 4 else f"{d} {i}" for i in range(40_000))) for d in range(2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.text for r in line_dedup.drop_repeated_passages(docs).collect()}
    assert got[0] == rows[0][1]
    assert got[1] == "\n".join(f"1 {i}" for i in range(0, 40_000, 4))


def test_line_dedup_loses_nothing_else(spark, sf, odd_docs, no_docs):
    """Every removed line stands, byte for byte, in the kept text of some document."""
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    before = {r.doc_id: r.text for r in docs.collect()}
    after = line_dedup.drop_repeated_passages(docs, removed="gone").collect()
    kept = {line for r in after for line in r.text.split("\n")}
    removed = 0
    for r in after:
        lines = before[r.doc_id].split("\n")
        left = set(range(len(lines)))
        for first, last in r.gone:
            assert {line for line in lines[first : last + 1] if line.strip(" ")} <= kept
            left -= set(range(first, last + 1))
            removed += 1
        assert r.text == "\n".join(lines[i] for i in sorted(left))
    assert removed > 0
    odd = line_dedup.drop_repeated_passages(odd_docs.drop("removed"))
    assert odd.count() == odd_docs.count()
    assert line_dedup.drop_repeated_passages(no_docs).collect() == []


def test_queries_are_whole(spark, sf):
    n = spark.read.parquet(f"{sf}/documents.parquet").count()
    for name in ("op1_line_dedup", "op3_exact_dedup", "op6_simhash"):
        assert queries.QUERIES[name](spark, sf).count() == n
