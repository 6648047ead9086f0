"""Language model, packing, classifiers, extraction, personal data and the pipeline."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from molspark.llm import extraction, language_model, packing, pii, quality, queries, toxicity


def words(text):
    return (text or "").encode().lower().split()


# --- Language model ---------------------------------------------------------------------------


def brute_base(docs):
    training = [t for d, t in docs if d is None or zlib.crc32(str(d).encode()) % 10]
    counts = Counter(w for t in training for w in [*words(t), b""])
    total, distinct = sum(counts.values()), len(counts)
    out = []
    for d, t in docs:
        tokens = [*words(t), b""]
        base = sum(math.log10((counts[w] + 0.1) / (total + 0.1 * (distinct + 1))) for w in tokens)
        held = d is not None and zlib.crc32(str(d).encode()) % 10 == 0
        out.append((d, held, len(tokens), sum(counts[w] > 0 for w in tokens), total, round(base, 6)))
    return Counter(out)


@pytest.mark.parametrize("head", [1 << 17, 300])
def test_language_model_base(spark, sf, odd_docs, no_docs, head, monkeypatch):
    monkeypatch.setattr(language_model, "HEAD", head)
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    docs = docs.unionByName(odd_docs.select((F.col("doc_id") + 10_000).alias("doc_id"), "text"))
    got = language_model.score(docs).collect()
    plain = [(r.doc_id, r.text) for r in docs.collect()]
    assert Counter((*r[:5], round(r.base_score, 6)) for r in got) == brute_base(plain)
    assert all(math.isfinite(r.score) and r.score < 0 for r in got)
    assert language_model.score(no_docs).collect() == []


def test_language_model_trains_on_every_document(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    v = language_model.build_vocabulary(language_model.count_words(docs))
    context = spark.sparkContext
    vocabulary, weights = context.broadcast(v), context.broadcast(language_model.Network(v).w)
    rounds = [language_model.train_round(docs, vocabulary, weights, k, 3) for k in range(language_model.ROUNDS)]
    assert sum(r["embed"][0] for r in rounds if r) == v.total


def test_language_model_beats_word_counts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held = [r for r in language_model.score(docs).collect() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def vocabulary():
    rng = random.Random(1)
    head = sorted(((f"w{i}".encode(), rng.randint(2, 900)) for i in range(300)), key=lambda x: (-x[1], x[0]))
    head[0] = (b"", head[0][1])
    tail = [(f"rare{i}".encode(), 1) for i in range(50)]
    sums = np.zeros(language_model.SPELT)
    for w, c in head + tail:
        sums[language_model.spelt_class(w)] += c + 0.1
    total = sum(c for _, c in head + tail)
    return language_model.Vocabulary(head, sums, total, 350), head, tail


def test_classes_of_many_words_are_those_of_each():
    """Also for words without letters, of one byte, of bytes beyond ASCII, and in a slice of an array."""
    rng = random.Random(4)
    words = [bytes(rng.choice(b"az`{0.A\x00\x7f\x80\xff") for _ in range(rng.randint(0, 5))) for _ in range(3000)]
    array = pa.array(words, pa.binary())
    expected = [language_model.spelt_class(w) for w in words]
    assert language_model.spelt_classes(array).tolist() == expected
    assert language_model.spelt_classes(array.slice(70, 900)).tolist() == expected[70:970]
    assert language_model.spelt_classes(array[:0]).tolist() == []


def test_words_of_the_head_have_their_places_as_codes():
    """One look at the words of some texts codes them: those of the head by place, others after it."""
    v, head, _ = vocabulary()
    texts = pa.array(["w3 NEW  w299 rare1\n", None, "", "new w3 \u00e9"])
    codes, distinct, counts = language_model.tokenised(texts, v.known())
    assert counts.tolist() == [4, 0, 0, 3]
    assert [distinct[int(c)].as_py() for c in codes] == [w for t in texts.to_pylist() for w in words(t)]
    assert [int(c) if c < len(v.words) else None for c in codes] == [
        v.words.index(w) if w in v.words else None for t in texts.to_pylist() for w in words(t)
    ]
    assert distinct.to_pylist()[: len(v.words)] == v.words
    expected = [i if i < v.neural else v.neural + language_model.spelt_class(w) for i, w in enumerate(distinct.to_pylist())]
    assert v.entries(distinct).tolist() == expected


def test_sums_of_rows_are_those_of_reduceat():
    """To the bit, so that weights don't change: groups of one row, of few and of many."""
    rng = np.random.default_rng(3)
    for n, groups in ((1, 1), (60, 4), (3000, 900), (5000, 6), (9, 9), (300, 1)):
        key = np.sort(rng.integers(0, groups, n))
        order, start = rng.permutation(n), np.flatnonzero(np.diff(key, prepend=-1))
        values = rng.normal(0, 1, (n, 48)).astype(np.float32)
        assert np.array_equal(language_model.row_sums(values, order, start), np.add.reduceat(values[order], start))


def test_classes_are_worked_out_some_states_at_a_time(monkeypatch):
    """However many at a time, also where the last ones are fewer; no states at all give nothing."""
    monkeypatch.setattr(language_model, "NEURAL", 128)
    v, *_ = vocabulary()
    rng = np.random.default_rng(5)
    network = language_model.Network(v, {k: x + rng.normal(0, 0.2, x.shape) for k, x in language_model.Network(v).w.items()})
    h, kind = rng.normal(0, 1, (50, language_model.STATE)).astype(np.float32), rng.integers(0, network.kinds, 50)
    within = np.where(kind < v.classes, rng.integers(0, 64, 50), 0)
    whole, grads, dh = network.output(h, kind, within, True)
    for some in (1, 7, 50):
        monkeypatch.setattr(language_model, "ROWS", some)
        assert np.allclose(network.output(h, kind, within), whole, rtol=1e-5)
        got, g, d = network.output(h, kind, within, True)
        assert np.allclose(got, whole, rtol=1e-5) and np.allclose(d, dh, atol=1e-5)
        assert all(np.allclose(g[k], grads[k], atol=1e-4) for k in grads)
    assert network.output(h[:0], kind[:0], within[:0]).tolist() == []


def test_probabilities_add_up(monkeypatch):
    """Over all known words and one unknown word for each spelt class, after any history."""
    monkeypatch.setattr(language_model, "NEURAL", 128)
    v, head, tail = vocabulary()
    rng = np.random.default_rng(2)
    weights = {k: x + rng.normal(0, 0.3, x.shape) * (np.abs(x) < 1e8) for k, x in language_model.Network(v).w.items()}
    network = language_model.Network(v, weights)
    h = rng.normal(0, 1, (1, language_model.STATE)).astype(np.float32)
    total = 0.0
    for place, (word, _) in enumerate(head):
        kind, within = v.kind[place], place % language_model.CLASS_SIZE if place < v.neural else 0
        p = math.exp(network.output(h, np.array([kind]), np.array([within]))[0])
        total += p if place < v.neural else p * (v.counts[place] + 0.1) / v.spelt_sums[kind - v.classes]
    for k in range(language_model.SPELT):
        p = math.exp(network.output(h, np.array([v.classes + k]), np.array([0]))[0])
        own = sum(c + 0.1 for w, c in tail if language_model.spelt_class(w) == k)
        total += p * (own + 0.1) / v.spelt_sums[k]
    assert total == pytest.approx(1, abs=1e-4)


def test_gradients(monkeypatch):
    """Backpropagation against differences, over a window with a document start inside."""
    monkeypatch.setattr(language_model, "NEURAL", 128)
    v, *_ = vocabulary()
    rng = np.random.default_rng(4)
    weights = {k: (x + rng.normal(0, 0.2, x.shape)) for k, x in language_model.Network(v).w.items()}
    network = language_model.Network(v, weights)
    network.w = {k: x.astype(np.float64) for k, x in network.w.items()}
    h = rng.normal(0, 1, (12, language_model.STATE))
    kind, within = rng.integers(0, network.kinds, 12), rng.integers(0, 5, 12)
    within = np.where(kind < v.classes, within, 0)
    _, grads, dh = network.output(h, kind, within, True)
    loss = lambda: -network.output(h, kind, within).sum()
    for name in ("to_class", "to_word"):
        flat, g = network.w[name].reshape(-1), grads[name].reshape(-1)
        for i in rng.integers(0, len(flat), 5):
            old, eps = flat[i], 1e-5
            flat[i] = old + eps
            up = loss()
            flat[i] = old - eps
            down = loss()
            flat[i] = old
            assert g[i] == pytest.approx((up - down) / 2e-5, abs=1e-5)
    i, j = 3, 7
    old = h[i, j]
    h[i, j] = old + 1e-5
    up = loss()
    h[i, j] = old - 1e-5
    down = loss()
    h[i, j] = old
    assert dh[i, j] == pytest.approx((up - down) / 2e-5, abs=1e-5)


def test_gradients_through_time(monkeypatch):
    """What training steps down, against differences of the log-likelihood: inputs, recurrence and gates' bias."""
    v, *_ = vocabulary()
    rng = random.Random(6)
    texts = pa.array([" ".join(f"w{rng.randint(0, 320)}" for _ in range(n)) for n in (9, 4, 0, 14)])
    network = language_model.Network(v)
    noise = np.random.default_rng(1)
    network.w = {k: (x + noise.normal(0, 0.4, x.shape) * (np.abs(x) < 1e8)).astype(np.float32) for k, x in network.w.items()}
    start, found = {k: x.copy() for k, x in network.w.items()}, {}

    def learn(self, name, gradient, memory, rows=slice(None)):
        found[name] = np.zeros_like(start[name])
        found[name][rows] = gradient

    monkeypatch.setattr(language_model.Network, "learn", learn)
    reader = language_model.read_batch(v, texts, 2)[0]
    memory = {k: np.zeros_like(x) for k, x in network.w.items()}
    n = language_model.train(network, reader, memory)
    assert n == 31 and set(found) == {"embed", "recur", "bias", "to_class", "to_word"}
    loss = lambda: -language_model.neural_scores(network, reader, 4).sum() / n
    for name, g in found.items():
        flat = network.w[name].reshape(-1)
        for i in np.argsort(-np.abs(g.reshape(-1)))[:6]:
            old = flat[i]
            ends = []
            for eps in (0.01, -0.01):
                flat[i] = old + eps
                ends.append(loss())
            flat[i] = old
            assert g.reshape(-1)[i] == pytest.approx((ends[0] - ends[1]) / 0.02, rel=0.02, abs=2e-4)


def brute_scores(v, w, texts):
    """log10 probabilities, word by word, in plain double arithmetic."""
    w = {k: x.astype(float) for k, x in w.items()}
    size, place = language_model.STATE, {x: i for i, x in enumerate(v.words)}
    sigmoid = lambda x: 1 / (1 + np.exp(-x))
    out = []
    for text in texts:
        h, total, last = np.zeros(size), 0.0, b""
        for word in [*words(text), b""]:
            def spot(x):
                i = place.get(x, -1)
                return i if 0 <= i < v.neural else v.neural + language_model.spelt_class(x)

            own, rec = w["embed"][spot(last)] + w["bias"], h @ w["recur"]
            r, z = sigmoid(own[:size] + rec[:size]), sigmoid(own[size : 2 * size] + rec[size : 2 * size])
            h = (1 - z) * h + z * np.tanh(own[2 * size :] + r * rec[2 * size :])
            logits = h @ w["to_class"] + w["class_bias"]
            i = spot(word)
            kind = i // language_model.CLASS_SIZE if i < v.neural else v.classes + i - v.neural
            total += logits[kind] - np.log(np.exp(logits).sum())
            if i < v.neural:
                inner = h @ w["to_word"][kind] + w["word_bias"][kind]
                total += inner[i % language_model.CLASS_SIZE] - np.log(np.exp(inner).sum())
            else:
                total += np.log((v.all_counts.get(word, 0) + 0.1) / v.spelt_sums[kind - v.classes])
            last = word
        out.append(total / math.log(10))
    return out


def test_scores_equal_brute_force_and_ignore_the_split(spark, sf, monkeypatch):
    """Scores by plain loops from the fitted weights; one partition or eight, many shards, a small head."""
    monkeypatch.setattr(language_model, "HEAD", 700)
    monkeypatch.setattr(language_model, "NEURAL", 256)
    monkeypatch.setattr(language_model, "SHARD_WORDS", 3_000)
    monkeypatch.setattr(language_model, "PIECE", 5_000)
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    kept, fit, build = [], language_model.fit, language_model.build_vocabulary
    monkeypatch.setattr(language_model, "fit", lambda *a: kept.append(fit(*a)) or kept[-1])
    monkeypatch.setattr(language_model, "build_vocabulary", lambda c: kept.append(build(c)) or kept[-1])
    one = {r.doc_id: r.score for r in language_model.score(docs.repartition(1)).collect()}
    eight = {r.doc_id: r.score for r in language_model.score(docs.repartition(8)).collect()}
    assert max(abs(one[d] - eight[d]) / abs(one[d]) for d in one) < 1e-6
    v, w = kept[0], kept[1]
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    training = [t for d, t in rows if zlib.crc32(str(d).encode()) % 10]
    v.all_counts = Counter(x for t in training for x in [*words(t), b""])
    short = sorted(rows, key=lambda r: len(r[1] or ""))[:60]
    for (d, _), want in zip(short, brute_scores(v, w, [t for _, t in short])):
        assert one[d] == pytest.approx(want, rel=1e-4)


def test_the_end_is_known_outside_the_head(spark, monkeypatch):
    """More frequent words than the head holds, all of one count: the end still counts."""
    monkeypatch.setattr(language_model, "HEAD", 20)
    docs = spark.createDataFrame([(i, " ".join(f"w{k}" for k in range(400))) for i in range(6)], "doc_id long, text string")
    got = language_model.score(docs).collect()
    assert Counter((*r[:5], round(r.base_score, 6)) for r in got) == brute_base([(r.doc_id, r.text) for r in docs.collect()])


def test_state_carries_over_windows(monkeypatch):
    """The score of a document depends neither on the window nor on its neighbours in the batch."""
    v, *_ = vocabulary()
    rng = random.Random(3)
    texts = [" ".join(f"w{rng.randint(0, 320)}" for _ in range(rng.randint(0, 300))) for _ in range(40)]
    network = language_model.Network(v)
    network.w["to_class"] = np.random.default_rng(0).normal(0, 0.5, network.w["to_class"].shape).astype(np.float32)

    def run(some, steps, width):
        monkeypatch.setattr(language_model, "STEPS", steps)
        return language_model.neural_scores(network, language_model.read_batch(v, pa.array(some), width)[0], len(some))

    whole = run(texts, 1000, 7)
    assert np.allclose(whole, run(texts, 8, 3), rtol=1e-4)
    assert np.allclose(whole, [run([t], 5, 1)[0] for t in texts], rtol=1e-4)


# --- Packing ----------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(queries.tokenizer_path())


def check_pieces(pieces, docs, tokenizer, capacity):
    want = Counter()
    for d, t in docs:
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1]
        want[d, np.array(ids, "<u4").tobytes()] += 1
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in pieces:
        assert len(r.ids) == 4 * r.length and r.length > 0
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append((r.offset, r.length))
    got = Counter()
    for d, rows in by_doc.items():
        # Repeated ids: pieces are told apart by start and total only up to equal documents.
        rows.sort(key=lambda r: r.start)
        while rows:
            ids, at, total = b"", 0, rows[0].doc_tokens
            while at < total:
                options = [r for r in rows if r.start == at and r.doc_tokens == total]
                good = [r for r in options if any(k[0] == d and k[1].startswith(ids + bytes(r.ids)) for k in want)]
                ids, at = ids + bytes(good[0].ids), at + good[0].length
                rows.remove(good[0])
            got[d, ids] += 1
    assert got == want
    lengths = []
    for members in by_sequence.values():
        at = 0
        for offset, length in sorted(members):
            assert offset == at
            at += length
        assert at <= capacity
        lengths.append(at)
    return lengths


def test_pack(spark, sf, odd_docs, no_docs, tokenizer):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    special = "hello <|endoftext|> world"
    docs = docs.unionByName(spark.createDataFrame([(-1, special)], "doc_id long, text string"))
    assert tokenizer.encode(special, add_special_tokens=False).ids == [31373, 220, 50256, 995]
    plain = [(r.doc_id, r.text) for r in docs.collect()]
    for kwargs in ({}, {"block_tokens": 5_000, "capacity": 512}):
        pieces = packing.pack(docs.repartition(6), queries.tokenizer_path(), **kwargs).collect()
        lengths = check_pieces(pieces, plain, tokenizer, kwargs.get("capacity", 2048))
        assert sum(n < kwargs.get("capacity", 2048) for n in lengths) <= 1
    odd = packing.pack(odd_docs, queries.tokenizer_path()).collect()
    check_pieces(odd, [(r.doc_id, r.text) for r in odd_docs.collect()], tokenizer, 2048)
    assert packing.pack(no_docs, queries.tokenizer_path()).collect() == []


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(" \n\t \u0085.,'s019aZéß²日 <|>"), st.characters(codec="utf-8")), max_size=60))
def test_encoder(text):
    from tokenizers import Tokenizer

    if not hasattr(test_encoder, "made"):
        test_encoder.made = Tokenizer.from_file(queries.tokenizer_path())
    want = np.array(test_encoder.made.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
    assert packing.encoder(queries.tokenizer_path())(text) == want


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=60))
def test_balance(lengths):
    out = packing.balance(lengths, 64)
    assert sum(sum(n for *_, n in s) < 64 for s in out) <= 1
    seen = defaultdict(list)
    for s in out:
        for piece, start, n in s:
            seen[piece].append((start, n))
    for piece, length in enumerate(lengths):
        at = 0
        for start, n in sorted(seen[piece]):
            assert start == at
            at += n
        assert at == length


def test_balance_evens_cost():
    rng = random.Random(1)
    out = packing.balance([rng.randint(10, 700) for _ in range(400)], 2048)
    costs = [sum(packing.cost(n) for *_, n in s) for s in out[:-1]]
    assert max(costs) < 1.5 * sum(costs) / len(costs)


# --- Quality ----------------------------------------------------------------------------------


def test_quality(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    fold = F.pmod(F.xxhash64("doc_id"), F.lit(3)) == 0
    scored = quality.scores(docs, labels.where(~fold)).join(labels.where(fold), "doc_id").collect()
    assert len(scored) > 90
    assert sum(r.rejected == (r.quality == 0) for r in scored) >= 0.97 * len(scored)
    kept = quality.drop_rejected(docs, labels)
    assert kept.columns == docs.columns
    scores = {r.doc_id: r.rejected for r in quality.scores(docs, labels).collect()}
    assert {r.doc_id for r in kept.collect()} == {d for d, gone in scores.items() if not gone}


def test_quality_shrinks_sparse_sites(spark):
    good, bad = "Some words of plain prose, told in order. " * 5, "BUY!! NOW!! " * 20
    rows, n = [], 0
    for source, count, share in (("http://a.example/x/1", 60, 1.0), ("http://b.example/x/1", 60, 0.0), ("http://c.example/y", 1, 0.0)):
        for i in range(count):
            n += 1
            rows.append((n, good if i < share * count else bad, source, "en"))
    rows += [(900, good, "http://a.example/x/2", "en"), (901, good, "http://b.example/x/2", "en"), (902, good, "http://c.example/z", "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    labels = docs.where("doc_id < 900 AND doc_id % 2 = 0").select("doc_id", F.col("text").startswith("Some").cast("int").alias("quality"))
    got = {r.doc_id: r for r in quality.scores(docs, labels).collect()}
    assert got[900].site == "a.example" and got[900].path == "x"
    assert got[901].path_posterior < got[902].path_posterior < got[900].path_posterior
    assert got[901].score < got[902].score < got[900].score


def test_quality_odd(odd_docs, no_docs, spark):
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 1), (None, 1, 1), (3, None, None), (8, 0, 0)], "doc_id long, quality int, toxic int")
    assert quality.scores(odd_docs, labels).count() == odd_docs.count()
    assert quality.drop_rejected(odd_docs, labels).columns == odd_docs.columns
    assert quality.drop_rejected(odd_docs, labels.limit(0)).count() == odd_docs.count()
    assert quality.scores(no_docs, labels).collect() == []
    assert quality.drop_rejected(no_docs, labels).collect() == []


# --- Toxicity ---------------------------------------------------------------------------------


def test_toxicity(spark):
    rng = random.Random(6)
    common = [f"word{i}" for i in range(300)]
    rows = []
    for d in range(600):
        w = [rng.choice(common) for _ in range(rng.randint(5, 80))]
        toxic = d % 5 == 0
        if toxic:
            w[rng.randrange(len(w))] = "gru" + rng.choice(["ble", "mpf", "zz", "nk"])
        rows.append((d, " ".join(w), int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int").withColumn("score", F.lit(5))
    labels = docs.select("doc_id", "toxic")
    got = toxicity.scores(docs, labels).join(labels, "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert {r.doc_id for r in held} == {d for d in range(600) if zlib.crc32(str(d).encode()) % 4 == 2}
    assert sum(r.predicted == r.toxic for r in held) >= 0.97 * len(held)
    # Labels of held-out rows are never read.
    turned = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    again = {r.doc_id: r.score for r in toxicity.scores(docs, turned).collect()}
    assert again == {r.doc_id: r.score for r in got}


def test_toxicity_odd(odd_docs, no_docs, spark):
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 0), (8, 1), (None, 1), (9, None)], "doc_id long, toxic int")
    for some in (labels, labels.limit(0), labels.where("toxic = 0")):
        got = toxicity.scores(odd_docs, some).collect()
        assert len(got) == odd_docs.count() and all(0 <= r.score <= 1 for r in got)
    assert all(r.predicted == 0 for r in got)
    assert toxicity.scores(no_docs, labels).collect() == []


def test_toxicity_reads_whole_texts():
    place = np.full(toxicity.BUCKETS, 1, np.int16)
    end = b"xyzzyqwert"
    gram = end[1:5]
    a = np.frombuffer(gram, np.uint8).astype(np.uint32)
    h = a[:1]
    for n in range(1, 4):
        h = h * np.uint32(0x01000193) + a[n : n + 1]
    bucket = int((((h ^ np.uint32(4)) * np.uint32(0x9E3779B1)) >> np.uint32(32 - toxicity.BUCKET_BITS))[0])
    place[:] = 1
    place[bucket] = 0
    for shift in range(-8, 9):
        for fill in ("a", "ä", "日"):
            text = (fill * (toxicity.PIECE + shift)).encode() + end
            assert list(toxicity.present(text, place, np.zeros(2, bool))) == [0]


def test_toxicity_grams_are_of_characters():
    def brute(text):
        codes = [ord(c) for c in " " + "".join(c.lower() if c.isascii() else c for c in text) + " "]
        out = set()
        for n in toxicity.ORDERS:
            for i in range(len(codes) - n + 1):
                h = codes[i]
                for c in codes[i + 1 : i + n]:
                    h = (h * 0x01000193 + c) % 2**32
                out.add((((h ^ n) * 0x9E3779B1) % 2**32) >> (32 - toxicity.BUCKET_BITS))
        return out

    for text in ("", "a", "ab", "Größe ÄB", "日本語のテキスト", "mixed \U0001f600 tèxt"):
        assert {int(b) for h in toxicity.buckets_of(text.encode()) for b in h} == brute(text)
    assert {int(b) for h in toxicity.buckets_of(b"a\xffbcd") for b in h} == brute("a\ufffdbcd")


def test_one_labelled_id_in_many_rows(spark):
    """A labelled id with most of the rows gives one row to the sample of either classifier."""
    rows = [(1, f"repeated {i % 50} again") for i in range(2_000)] + [(d, f"other {d}") for d in range(3, 40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("source", F.lit("s"))
    labels = spark.createDataFrame([(d, d % 2, d % 2) for d in range(1, 40)], "doc_id long, quality int, toxic int")
    picked = toxicity._sampled(docs, labels, "toxic", 100).collect()
    learnt = [d for d in (1, *range(3, 40)) if zlib.crc32(str(d).encode()) % 4 != 2]
    assert len(picked) == len(learnt) and sum(r.text.startswith("repeated") for r in picked) == (1 in learnt)
    assert quality.scores(docs, labels).count() == toxicity.scores(docs, labels).count() == len(rows)
    few = docs.dropDuplicates(["doc_id", "text"])
    scores = [{(r.doc_id, round(r.score, 9)) for r in toxicity.scores(x, labels).collect()} for x in (docs, few)]
    assert scores[0] == scores[1]


# --- Extraction -------------------------------------------------------------------------------

PAGE = """<!DOCTYPE html><html><head><title>T &amp; t</title><style>p{{}}</style><script>var t="</p>";</script></head><body>
<header class="site-header"><h2>Site name</h2></header><nav><ul><li><a href=x>Home</a></li><li>News</li></ul></nav>
<div class="cookie-notice">We use cookies, lots of cookies, very many cookies indeed.</div><div id=main><div class="post-{n}">
<article><h1>Title {n}</h1><p>First &lt;para&gt;  with <b>bold</b>
text &#233;.<br>More<p>Second, unclosed<ul><li>item one<li>item two</ul><form><p>Your mail</p><input></form>
<!-- <p>not this</p> --><aside>Related things</aside><div class="comments"><p>I disagree with all of this, a long comment by a reader.</p></div></article>
</div></div><div class="ad">Buy this</div><footer>&copy; me</footer></body></html>"""
WANT = "Title {n}\nFirst <para> with bold text é. More\nSecond, unclosed\nitem one\nitem two"


def test_extract(spark):
    rows = [(n, f"http://Host{n % 2}.example/{n}?q", PAGE.format(n=n)) for n in range(8)]
    rows += [(50, "http://other.example/", None), (51, None, ""), (None, "no url", "just text &amp; more"), (52, "http://x.example", "<p>a<p>b")]
    rows += [rows[0], (53, "http://host0.example/z", "<html><body><p>Only a body here.</p></body></html>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("path", F.lit("x")).withColumn("text", F.lit(1))
    got = Counter((r.page_id, r.text) for r in extraction.extract(pages).collect())
    want = Counter((n, WANT.format(n=n)) for n in range(8))
    want.update([(50, ""), (51, ""), (None, "just text & more"), (52, "a\nb"), (0, WANT.format(n=0)), (53, "Only a body here.")])
    assert got == want
    assert extraction.extract(pages.limit(0)).collect() == []


def test_consensus_beats_one_odd_page(spark):
    """A page whose sidebar holds more text than its story still gives the story, as its host votes."""
    page = lambda story, side: f"<body><div class=story><p>{story}</p></div><div class=box><p>{side}</p></div></body>"
    rows = [(n, "http://h.example/", page("A story of some length, told well. " * 5, "short")) for n in range(5)]
    rows.append((9, "http://h.example/9", page("Brief story.", "A very long box of other things. " * 30)))
    got = {r.page_id: r.text for r in extraction.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[9] == "Brief story."


def test_no_article_text_is_lost():
    """Stray quotes, a page in one form, names that only hold a listed word, and a second template."""
    long = "The article has this to say, at some length, about its matter. " * 3

    def text(html, path=""):
        return extraction.main_text(extraction.blocks(html), path)

    assert text(f'<article><p title="a"">one</p><p>{long}</p></article>') == f"one\n{long.strip()}"
    assert text(f"<body><form><div><p>{long}</p></div></form></body>") == long.strip()
    page = f"<body><form><nav>Menu</nav><article><p>{long}</p><form>Name</form></article></form></body>"
    assert text(page) == long.strip()
    assert text(f'<div class="no-sidebar"><article><p>{long}</p></article></div>') == long.strip()
    parts = "".join(f'<{t} {a}>{n}</{t}>' for n, (t, a) in enumerate([("section", 'id="discussion"'), ("h2", 'id="search-and-related-work"'), ("div", 'id="social-effects"'), ("section", 'class="copyright-law"')]))
    assert text(f"<article>{parts}</article>") == "0\n1\n2\n3"
    junk = "".join(f'<div class="{c}">junk</div>' for c in ("share-buttons", "ad", "related posts", "comment-list", "site-nav"))
    assert text(f"<article>{junk}<p>{long}</p></article>") == long.strip()
    other = f'<div class="post"><p>{long}</p></div><div class="content"><p>Teaser only.</p></div>'
    assert text(other, ">div.post") == long.strip() and text(other, ">div.content") == "Teaser only."
    assert extraction.main_text(extraction.blocks(other), ">div.content", [">div.post"]) == long.strip()


def test_extract_given_pages(spark, sf):
    from html import unescape

    pages = spark.read.parquet(f"{sf}/pages.parquet")
    html = {r.page_id: r.html for r in pages.collect()}
    for r in extraction.extract(pages).collect():
        inner = re.search(r"<article>(.*)</article>", html[r.page_id], re.S)[1].replace("<br>", " ")
        parts = [" ".join(unescape(re.sub(r"</?b>", "", p)).split()) for p in re.split(r"</?(?:p|h1)>", inner)]
        assert r.text == "\n".join(p for p in parts if p)


# --- Personal data ----------------------------------------------------------------------------

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def brute_spans(text):
    out = []
    for kind, pattern in BASE.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == "card" and not (13 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append((kind, m.start(), m.end()))
    return out


def texts_with_data():
    rng = random.Random(8)
    bits = ["a@b.c", "@", "x.y%z@h-1.co.uk", "1.2.3.4", "256.1.1.1", "1.2.3.4.5.6.7.8", "007.1.1.255", "4111 1111 1111 1111",
            "4111-1111-1111-1112", "+1 (212) 555-0101", "+1((((", "+49.30.1234567", " ", "\n", "\x01", "\x02", "é", "\U0001f600",
            "12", "-", ".", "a.b", "joe (at) mail dot com", "(212) 555-0101", "5500 0000 0000 0004", "call", "card ", "%", "..", "@@"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 14))) for _ in range(400)]
    return [*texts, None, "", "a" * 50_000, "1 " * 30_000, "1." * 20_000, "a@" * 5_000, "+1 " * 5_000, "a@b.c " * 300, "a@b.c%d@e.f"]


def test_pii(spark, sf, odd_docs, no_docs):
    rows = list(enumerate(texts_with_data()))
    rows += [(10_000 + r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("some", F.lit(1)).withColumn("base", F.lit(2))
    texts = dict(rows)
    for r in pii.report(docs).collect():
        want = brute_spans(texts[r.doc_id])
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == kind for k, *_ in want) for kind in BASE], texts[r.doc_id]
        listed = ",".join(f"{k}:{a}:{b}" for k, a, b in want)
        assert r.base_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        found = [tuple(s.split(":")) for s in r.spans.split(",") if s]
        assert {(k, str(a), str(b)) for k, a, b in want} <= set(found)
        order = [(list(BASE).index(k), int(a)) for k, a, _ in found]
        assert order == sorted(order)
    assert pii.report(odd_docs).count() == odd_docs.count()
    assert pii.report(no_docs).collect() == []


def test_reliabilities():
    """Two good labelers and one that guesses: EM tells them apart without labels."""
    rng = random.Random(1)
    counts = Counter()
    truth = defaultdict(list)
    for _ in range(5000):
        y = rng.random() < 0.6
        vote = "".join("1" if (y if rng.random() < q else not y) else "0" for q in (0.95, 0.9, 0.5)) + "-"
        counts["phone", vote] += 1
        truth[vote].append(y)
    rows = [(k, v, n) for (k, v), n in sorted(counts.items())]
    p = pii.reliabilities(rows)
    trained = pii.span_classifier(rows, p)
    for vote, ys in truth.items():
        if len(ys) > 200:
            assert p["phone", vote] == pytest.approx(sum(ys) / len(ys), abs=0.1)
            assert (trained["phone", vote] > 0.5) == (sum(ys) / len(ys) > 0.5)


def test_learned_spans_are_added(spark):
    rows = [(i, f"call +1 (212) 555-01{i:02d} now") for i in range(50)]
    rows += [(100, "please call (212) 555-0199 today"), (101, "order no 212-555-0199x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.spans for r in pii.report(docs, add_from=0.5).collect()}
    assert got[100] == "phone:12:26" and got[101] == ""


# --- Pipeline ---------------------------------------------------------------------------------


def test_pipeline(spark, sf, odd_docs, no_docs):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "exact dedup", "near dedup", "decontamination", "packing"]
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept = {r.doc_id: r.text for r in docs.collect()}
    current = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        current = stage(spark, current, sf)
        assert current.columns == docs.columns
        ids = [r.doc_id for r in current.collect()]
        assert len(ids) == len(set(ids)) and set(ids) <= set(kept)
    flat = Counter(" ".join(kept[i].split()) for i in ids)
    assert max(flat.values()) == 1
    pieces = corpus_pipeline.run(spark, sf).collect()
    assert {r.doc_id for r in pieces} == set(ids)
    for odd in (odd_docs, no_docs):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            left = stage(spark, odd, sf)
            assert left.columns == odd.columns and left.count() <= odd.count()
        assert stage is not None and corpus_pipeline.STAGES[-1][1](spark, odd, sf).count() >= 0
