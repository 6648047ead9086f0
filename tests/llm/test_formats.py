"""Chat formatting, embedding whitening and fill-in-middle, against brute force and round trips."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from molspark.llm import chat, fill_middle, queries, whitening

# --- Chat -------------------------------------------------------------------------------------

MESSAGES = "conv_id long, id long, parent long, role string, text string, score double"


def brute_paths(rows, branches=1):
    """Best branches of each tree, walked message by message."""
    trees = defaultdict(lambda: defaultdict(list))
    for tree, i, parent, role, text, score in rows:
        trees[tree][i].append((parent, role or "", text or "", score))
    out = []
    for tree, nodes in trees.items():
        up = {i: min((r[0] for r in m if r[0] is not None), default=None) for i, m in nodes.items()}
        up = {i: p if p in nodes else None for i, p in up.items()}
        score = {i: max((r[3] for r in m if r[3] is not None), default=0.0) for i, m in nodes.items()}
        answered = {p for p in up.values() if p is not None}
        found = []
        for leaf in nodes:
            if leaf in answered:
                continue
            path, at = [leaf], leaf
            while up[at] is not None:
                at = up[at]
                path.append(at)
            mean = sum(score[i] for i in path) / len(path)
            found.append((-mean, leaf is None, leaf or 0, leaf, path[::-1]))
        for rank, (mean, _, _, leaf, path) in enumerate(sorted(found, key=lambda f: f[:3])[:branches], 1):
            turns = [t for i in path for t in sorted((r[1], r[2]) for r in nodes[i])]
            out.append((tree, leaf, rank, round(-mean, 9), turns))
    return sorted(out, key=str)


def got_paths(df):
    return sorted(
        ((r.tree, r.leaf, r.rank, round(r.score, 9), chat.turns_of(r.formatted)) for r in df.collect()), key=str
    )


def random_trees(seed, trees=12, most=18):
    rng, rows = random.Random(seed), []
    odd = ["", None, "<|im_end|>", "a<\\|b <\\\\|im_start|>", "x\ny<", "|", "\\", "é<|im_end|>\n<|im_start|>user\n"]
    for tree in range(trees):
        for i in range(rng.randint(1, most)):
            parent = rng.choice([None, *range(max(0, i - 3), i)]) if i else None
            role = rng.choice(["user", "assistant", "assistant", "system", None, "to\nol\\n<|"])
            rows.append((tree, i, parent, role, rng.choice(odd) if rng.random() < 0.5 else f"text {i}", rng.choice([None, rng.random()])))
    return rows


@pytest.mark.parametrize("branches", [1, None])
def test_paths_equal_brute_force(spark, branches):
    rows = random_trees(3, most=40)
    df = spark.createDataFrame(rows, MESSAGES)
    assert got_paths(chat.conversations(df, branches=branches)) == brute_paths(rows, branches)


def test_hot_trees_equal_others(spark, monkeypatch):
    rows = random_trees(5)
    df = spark.createDataFrame(rows, MESSAGES)
    monkeypatch.setattr(chat, "HOT_LEAST", 9)
    monkeypatch.setattr(chat, "HOT_SHARE", 20)
    sizes = Counter(r[0] for r in rows).values()
    assert min(sizes) <= 9 < max(sizes)
    assert got_paths(chat.conversations(df, branches=2)) == brute_paths(rows, 2)


def test_loss_spans(spark):
    df = chat.conversations(spark.createDataFrame(random_trees(9), MESSAGES), branches=2)
    for r in df.collect():
        spans = [(s.start, s.length) for s in r.loss]
        said = [text for role, text in chat.turns_of(r.formatted) if role == "assistant"]
        assert [chat.learnt_text(r.formatted, [s]) for s in spans] == said
        assert r.formatted.count(chat.TURN) == r.formatted.count(chat.END) == r.n_rows


def test_odd_messages(spark):
    rows = [
        (None, 1, None, "user", "in no tree", 1.0),
        (None, 2, 1, "assistant", "nor this", None),
        (1, 1, 99, "user", "unknown parent", None),
        (1, None, 1, "assistant", "null id", None),
        (2, 1, 2, "user", "round", 1.0),
        (2, 2, 1, "user", "and round", 1.0),
        (2, 3, 2, "user", "hangs on the circle", 1.0),
        (2, 4, 4, "user", "answers itself", 1.0),
        (3, 1, None, "user", "twice", None),
        (3, 1, None, "user", "twice", None),
        (3, 2, 1, None, None, float("-1")),
    ]
    df = spark.createDataFrame(rows, MESSAGES)
    for name in ("tree", "leaf", "kind", "paths", "t", "hot", "up"):
        df = df.withColumn(name, F.lit(1))
    want = [
        (None, 2, 1, 0.5, [("user", "in no tree"), ("assistant", "nor this")]),
        (1, None, 1, 0.0, [("user", "unknown parent"), ("assistant", "null id")]),
        (3, 2, 1, -0.5, [("user", "twice"), ("user", "twice"), ("", "")]),
    ]
    assert got_paths(chat.conversations(df)) == sorted(want, key=str)
    assert chat.conversations(df.limit(0)).collect() == []


def test_plain_conversations(spark):
    long = [(7, n, "assistant" if n % 2 else "user", f"t{n}") for n in range(700)]
    odd = [(1, None, "user", "last"), (1, 5, "user", None), (1, 5, "user", None), (1, -3, "system", ""), (None, 1, None, "x" * 300_000)]
    df = spark.createDataFrame(long + odd, "conv_id long, turn long, role string, text string").withColumn("id", F.lit(0))
    got = {r.tree: chat.turns_of(r.formatted) for r in chat.plain_conversations(df).collect()}
    assert got[7] == [(r, t) for _, _, r, t in long]
    assert got[1] == [("system", ""), ("user", ""), ("user", ""), ("user", "last")]
    assert got[None] == [("", "x" * 300_000)] and len(got) == 3
    assert chat.plain_conversations(df.limit(0)).collect() == []


@given(st.text("<|\\im_endstar>\n a", max_size=30), st.text("<|\\n\nr", max_size=8))
@settings(max_examples=300, deadline=None)
def test_escapes_are_reversible(text, role):
    hidden = re.sub(r"<(\\*)\|", r"<\\\1|", text)
    lined = re.sub(r"<(\\*)\|", r"<\\\1|", role.replace("\\", "\\\\").replace("\n", "\\n"))
    assert "<|" not in hidden and chat.unescaped(hidden) == text
    formatted = f"{chat.TURN}{lined}\n{hidden}{chat.END}"
    assert chat.turns_of(formatted * 2) == [(role, text)] * 2


# --- Whitening --------------------------------------------------------------------------------


def brute_whitening(vectors, k):
    x = [[math.floor(64 * c) + 1_000_000 for c in v] for v in vectors]
    n, dims = len(x), len(x[0])
    sums = [sum(r[d] for r in x) for d in range(dims)]
    off = [[n * a - s for a, s in zip(r, sums)] for r in x]
    cov = np.array([[sum(r[i] * r[j] for r in off) / n**3 for j in range(dims)] for i in range(dims)])
    values, vecs = np.linalg.eigh(cov)
    order = np.argsort(-values)[:k]
    w = np.array(off, float) / n @ vecs[:, order] / np.sqrt(values[order])
    return [sum(a * a for a in r) for r in off], w, values[order] / np.trace(cov)


def test_whitening_equals_brute_force(spark, sf):
    table = spark.read.parquet(f"{sf}/embeddings.parquet")
    vectors = {r.vec_id: r.embedding for r in table.collect()}
    ids = sorted(vectors)
    deviation, w, explained = brute_whitening([vectors[i] for i in ids], 32)
    got = {r.vec_id: r for r in whitening.whiten(table).collect()}
    assert sorted(got) == ids
    assert [int(got[i].deviation) for i in ids] == deviation
    mine = np.array([got[i].whitened for i in ids])
    assert np.allclose(np.abs(mine), np.abs(w), atol=1e-7)
    assert np.allclose(mine.T @ mine / len(ids), np.eye(32), atol=1e-9)
    assert np.allclose(got[ids[0]].explained, explained, rtol=1e-9)
    assert {r.identity_error < 1e-8 and r.n == len(ids) for r in got.values()} == {True}
    rows = queries.op12_whitening(spark, sf)
    assert rows.count() == 32 * len(ids) and rows.schema["deviation"].dataType.simpleString() == "bigint"


def test_scatter_is_exact():
    """Also where sums are far beyond longs, and over rows that don't fill words and blocks."""
    rng = random.Random(3)
    spreads = [1, 2, 1 << 20, 1 << 50]
    x = np.array([[rng.randrange(s) for s in spreads] for _ in range(333)], np.int64)
    bits = [max(1, int(v).bit_length()) for v in x.max(0)]
    counts = sum(whitening.plane_counts(whitening.planes(x[a : a + 100], bits)) for a in range(0, 333, 100))
    own, both = whitening.products(counts, bits)
    plain = x.astype(object)
    assert own == plain.sum(0).tolist()
    assert both == {(i, j): (plain[:, i] * plain[:, j]).sum() for i in range(4) for j in range(i, 4)}
    assert all(sum(p << whitening.LIMB * k for k, p in enumerate(whitening.limbs(v))) == v for v in both.values())


def test_whitening_of_odd_tables(spark):
    good = [(1, [0.5, 1.0, -2.0]), (2, [0.25, 3.0, 1.0]), (2, [0.25, 3.0, 1.0]), (None, [9.0, -1.0, 4.5]), (5, [1.5, 1.0, 1e3])]
    bad = [(6, None), (7, [1.0, None, 2.0]), (8, [float("nan"), 1.0, 1.0]), (9, [float("inf"), 1.0, 1.0]), (10, [1e30, 0.0, 0.0]), (11, [1.0]), (12, [])]
    df = spark.createDataFrame(good + bad, "vec_id long, embedding array<float>").withColumn("n", F.lit("x")).withColumn("v", F.lit(0))
    got = whitening.whiten(df).collect()
    deviation, w, _ = brute_whitening([v for _, v in good], 3)
    assert Counter((r.vec_id, int(r.deviation)) for r in got) == Counter(zip((i for i, _ in good), deviation))
    assert got[0].identity_error < 1e-6 and len(got[0].whitened) == 3
    assert whitening.whiten(df.limit(0)).collect() == []
    assert whitening.whiten(df.where("vec_id = 12 OR embedding IS NULL")).collect() == []
    one = whitening.whiten(df.where("vec_id = 2")).collect()
    assert [(r.whitened, int(r.deviation), r.n, r.identity_error) for r in one] == [([0.0] * 3, 0, 2, 0.0)] * 2
    wide = spark.createDataFrame([(i, [float(i), float(2**50 * (i % 7))]) for i in range(50)], "vec_id long, embedding array<double>")
    assert sum(r.whitened[0] ** 2 for r in whitening.whiten(wide).collect()) / 50 == pytest.approx(1)


# --- Fill in middle ---------------------------------------------------------------------------

TEXTS = st.text(st.sampled_from("abZ .\n<P>SMé日\U0001f600\x00"), max_size=60)


def brute_units(text):
    return re.findall(r"[A-Za-z]+|[^A-Za-z]", text, re.S)


def brute_fim(doc_id, text):
    units = brute_units(text)
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k : 8 * k + 8], 16) for k in range(4))
    a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    p, m, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return len(units), "plain", None, None, text
    if h4 % 100 < 20:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@given(TEXTS, st.integers(-5, 10**12))
@settings(max_examples=400, deadline=None)
def test_fill_middle_equals_brute_force(text, doc_id):
    n, form, p, m, output = fill_middle.transformed(doc_id, text.encode())
    assert (n, form, p, m, output.decode()) == brute_fim(doc_id, text)
    assert fill_middle.restored(output, form).decode() == text


@given(TEXTS, st.integers(1, 9))
@settings(max_examples=300, deadline=None)
def test_index_and_units_by_blocks(text, block):
    raw = text.encode()
    index, units = fill_middle.Exceptions(raw, block), fill_middle.Units(raw, block)
    ends = [len(text[:k].encode()) for k in range(len(text) + 1)]
    assert [index.points(b) for b in ends] == list(range(len(text) + 1))
    assert [index.bytes(k) for k in range(len(text) + 1)] == ends
    want = np.cumsum([0, *(len(u.encode()) for u in brute_units(text))]).tolist()
    assert [units.start(k) for k in range(units.count + 1)] == want
    p, m, s = fill_middle.parts_of(raw, len(text) // 3, len(text) // 2)
    assert (p + m + s, len(p.decode()), len(m.decode())) == (raw, len(text) // 3, len(text) // 2)


def test_fill_middle_of_odd_documents(spark, odd_docs, no_docs):
    got = fill_middle.transform(odd_docs).collect()
    want = Counter((r.doc_id, *brute_fim(r.doc_id, r.text or "")) for r in odd_docs.collect())
    assert Counter((*r[:5], bytes(r.output).decode()) for r in got) == want
    back = fill_middle.restore(fill_middle.transform(odd_docs), ["doc_id"]).collect()
    assert Counter((r.doc_id, bytes(r.text).decode()) for r in back) == Counter((r.doc_id, r.text or "") for r in odd_docs.collect())
    assert fill_middle.transform(no_docs).collect() == []
