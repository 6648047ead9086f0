"""Log-likelihood of documents under a gated recurrent language model (operator 2).

Words are counted over all training documents. The HEAD most frequent words are known to every task by
a broadcast table of bounded size; the rest of the vocabulary stays a distributed table that the rarer
words of the documents are joined with.

The model reads a document word by word: a gated recurrent unit in numpy, whose state is carried from
window to window over the whole document. Its output is class-factored: a softmax over classes, then
one within the class. The NEURAL most frequent words make up frequency classes with a softmax of their
own; every other word belongs to a class told by its spelling, in which it has the probability
(count + 0.1) over the class's sum, and so has, in each class, a word never seen (count 0). So the
probabilities of all known words and of an unknown word of each class add up to one.

Training is truncated backpropagation over every training document, once. The documents are dealt over
ROUNDS rounds and, inside a round, over shards of about SHARD_WORDS words, both by a hash of id and text; in a
round every shard starts from the same weights, trains on its documents in the order of their ids, and the
weights are averaged by words seen, block by block in Spark. So the model depends on the rows only, not on
how the table is split. Shards lie sorted in their partitions and are read as a stream.

Defined cases: null text counts as empty; an empty text is its end alone; a null doc_id counts as a
training document; repeated rows are rows; an empty table gives no rows; without training words every
word is unknown; other columns don't matter.
"""

from __future__ import annotations

import itertools
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from molspark.llm.common import arrow_schema, id_and_text, schema_of, text_pieces
from molspark.session import materialised, shuffle_partitions

HEAD = 1 << 17  # words broadcast with their counts
NEURAL = 4096  # of these, words with output weights of their own
CLASS_SIZE = 64
SPELT = 32  # classes of words told by their spelling
STATE = 16
SMOOTH = 0.1
FOLDS = 10
ROUNDS = 2  # together they read every training document
LANES, STEPS = 256, 32  # documents read side by side at most, and words in a window
TRAIN_LANES, TRAIN_STEPS = 256, 32
SHARD_WORDS = 4_000_000
ROWS = 512  # states whose classes are worked out at once
SHORT = 8  # rows of a group that are added up side by side
PIECE = 10_000_000  # bytes of text that are made into arrays at once
RATE, DAMPING = 0.2, 1e-6
PRIOR_WORDS = 10_000  # words that the weights before a round count for when its mean is taken
BOUND = 4.0  # of every weight, so that exponentials of float32 logits stay finite
PARTIAL = 8  # tasks whose weights are averaged at once
END = b""  # the end of a document; no word is empty
NO_LETTERS = bytes(b for b in range(128) if not 97 <= b <= 122)
LETTER = ~np.isin(np.arange(256), list(NO_LETTERS))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == 0, F.lit(False))


def spelt_class(word: bytes) -> int:
    """The class of a word without output weights: by its last two letters and what follows them."""
    letters = word.rstrip(NO_LETTERS)
    return zlib.crc32(letters[-2:] + b" " + word[len(letters) :][:1]) % SPELT


def spelt_classes(words: pa.BinaryArray) -> np.ndarray:
    """`spelt_class` of each word. It is worked out once for all words that are alike in the bytes it looks at."""
    if not len(words):
        return np.zeros(0, np.int32)
    cut = np.frombuffer(words.buffers()[1], np.int32)[words.offset : words.offset + len(words) + 1].astype(np.int64)
    start, end = cut[:-1], cut[1:]
    data = np.frombuffer(words.buffers()[2] or b"", np.uint8)[: cut[-1]]
    # One past the last letter up to each byte; the word's own start if it has none.
    ends = np.where(LETTER[data], np.arange(1, len(data) + 1, dtype=np.int32), np.int32(0))
    stop = np.maximum(np.maximum.accumulate(np.r_[np.int32(0), ends])[end], start)
    # The two bytes before that place and the one after it, as digits: 0 where the word has none.
    data = np.r_[data.astype(np.int32) + 1, 0, 0]
    key = np.where(stop - 2 >= start, data[stop - 2], 0)
    key = key * 257 + np.where(stop - 1 >= start, data[stop - 1], 0)
    key = key * 257 + np.where(stop < end, data[stop], 0)
    alike = pa.array(key).dictionary_encode()
    digits = [(x // 257**2, x // 257 % 257, x % 257) for x in alike.dictionary.to_pylist()]
    classes = [spelt_class(bytes(d - 1 for d in three if d)) for three in digits]
    return np.array(classes, np.int32)[alike.indices.to_numpy()]


def radix(codes: np.ndarray, bound: int) -> np.ndarray:
    """Codes below `bound` as the narrow integers that numpy sorts by radix, where they fit."""
    return codes.astype(np.uint16) if bound <= 1 << 16 else codes


def tokenised(texts: pa.Array, known: pa.BinaryArray | None = None) -> tuple[np.ndarray, pa.BinaryArray, np.ndarray]:
    """Codes of all words in order, the distinct words, and the number of words of each text.

    The words of `known`, which are distinct, have the first codes, in their order.
    """
    lowered = pc.ascii_lower(pc.fill_null(texts, ""))
    parts = pc.ascii_split_whitespace(lowered)
    owner = pc.list_parent_indices(parts).to_numpy()
    flat = pc.list_flatten(parts).cast(pa.binary())
    coded = (flat if known is None else pa.concat_arrays([known, flat])).dictionary_encode()
    distinct = coded.dictionary
    codes = coded.indices.to_numpy()[len(coded) - len(flat) :]
    empty = np.flatnonzero(pc.binary_length(distinct).to_numpy() == 0)
    if len(empty):
        real = codes != empty[0]
        codes, owner = codes[real], owner[real]
    return codes, distinct, np.bincount(owner, minlength=len(texts))


def count_words(docs: DataFrame) -> DataFrame:
    """(word, c, spelt): how often each word occurs in the training documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_schema("word binary, c bigint, spelt int")
        for batch in batches:
            for part in text_pieces(batch, PIECE):
                codes, distinct, _ = tokenised(part.column(1))
                counts = np.bincount(codes, minlength=len(distinct))
                words = pa.concat_arrays([distinct.filter(pa.array(counts > 0)), pa.array([END], pa.binary())])
                counts = np.r_[counts[counts > 0], part.num_rows]
                yield pa.RecordBatch.from_arrays(
                    [words, pa.array(counts, pa.int64()), pa.array(spelt_classes(words))], schema=schema
                )

    training = docs.where(~held_out(F.col("doc_id"))).select("doc_id", "text")
    counted = training.mapInArrow(run, schema_of("word binary, c bigint, spelt int"))
    return counted.groupBy("word", "spelt").agg(F.sum("c").alias("c"))


class Vocabulary:
    """What every task knows of the words; bounded by HEAD."""

    def __init__(self, head: list[tuple[bytes, int]], spelt_sums: np.ndarray, total: int, distinct: int):
        self.total, self.distinct = total, distinct
        self.neural = min(NEURAL, len(head))
        self.classes = -(-self.neural // CLASS_SIZE)
        self.words = [w for w, _ in head]
        self.counts = np.array([c for _, c in head] + [0], float)  # the last place: not in the head
        spelt = np.array([spelt_class(w) for w in self.words] + [0], np.int64)
        self.kind = self.classes + spelt
        self.kind[: self.neural] = np.arange(self.neural) // CLASS_SIZE
        # A spelt class holds its words without output weights, and one unknown word.
        sums = spelt_sums.astype(float)
        np.subtract.at(sums, spelt[: self.neural], self.counts[: self.neural] + SMOOTH)
        self.spelt_sums = np.maximum(sums, 0) + SMOOTH
        self.end = self.words.index(END) if END in self.words else len(self.words)
        self.head: pa.BinaryArray | None = None

    def known(self) -> pa.BinaryArray:
        """The words of the head, whose codes are so their places."""
        if self.head is None:
            self.head = pa.array(self.words, pa.binary())
        return self.head

    def entries(self, distinct: pa.BinaryArray) -> np.ndarray:
        """The input of each word of an array that begins with the head: its place if it has output weights, or its spelt class."""
        own, rest = np.arange(self.neural), self.kind[self.neural : len(self.words)] - self.classes
        spelt = np.r_[rest, spelt_classes(distinct.slice(len(self.words)))]
        return np.r_[own, self.neural + spelt].astype(np.int32)

    def biases(self) -> tuple[np.ndarray, np.ndarray]:
        """Log masses of the classes, and log counts of the neural words by class and place."""
        within = np.full((max(1, self.classes), CLASS_SIZE), -1e9)
        within.reshape(-1)[: self.neural] = np.log(self.counts[: self.neural] + SMOOTH)
        mass = [np.exp(row[row > -1e8]).sum() for row in within[: self.classes]]
        within -= within.max(1, keepdims=True) if self.neural else 0
        return np.log(np.array([*mass, *self.spelt_sums])), np.maximum(within, -1e9)


def build_vocabulary(counted: DataFrame) -> Vocabulary:
    """Sums over the whole vocabulary, and its head; at most HEAD words and SPELT sums reach the driver."""
    total, distinct = counted.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    sums = np.zeros(SPELT)
    for k, s in counted.groupBy("spelt").agg(F.sum(F.col("c") + F.lit(SMOOTH))).collect():
        sums[k] = s
    # The least count of the head, from a histogram of counts: no word is sorted outside the head.
    step = F.floor(F.log2(F.col("c").cast("double")) * 16)
    least, held = None, 0
    for _, low, n in sorted(counted.groupBy(step.alias("b")).agg(F.min("c"), F.count("*")).collect(), reverse=True):
        held += n
        if held > HEAD:
            break
        least = low
    if least is not None:
        top = counted.where(F.col("c") >= least)
    else:  # the words of the highest counts alone are more than HEAD
        top = counted.orderBy(F.desc("c"), "word").limit(HEAD)
    # The end of a document is always known, however few documents there are.
    top = top.where(F.col("word") != F.lit(END)).unionByName(counted.where(F.col("word") == F.lit(END)))
    head = sorted(top.select("word", "c").collect(), key=lambda r: (-r[1], bytes(r[0])))
    return Vocabulary([(bytes(w), c) for w, c in head], sums, total, distinct)


class Network:
    """A gated recurrent unit with class-factored output, and its backpropagation."""

    NAMES = ("embed", "recur", "bias", "to_class", "class_bias", "to_word", "word_bias")

    def __init__(self, vocabulary: Vocabulary, weights: dict[str, np.ndarray] | None = None):
        v, rng = vocabulary, np.random.default_rng(7)
        self.kinds = v.classes + SPELT
        self.neural, self.classes = v.neural, v.classes
        if weights is None:
            class_bias, word_bias = v.biases()
            small = lambda *shape: rng.normal(0, 0.1, shape)
            weights = {
                # Inputs: the neural words, then one for each spelt class.
                "embed": small(v.neural + SPELT, 3 * STATE),
                "recur": small(STATE, 3 * STATE),
                "bias": np.r_[np.zeros(STATE), -np.ones(STATE), np.zeros(STATE)],
                "to_class": np.zeros((STATE, self.kinds)),
                "class_bias": class_bias - class_bias.max(),
                "to_word": np.zeros((max(1, v.classes), STATE, CLASS_SIZE)),
                "word_bias": word_bias,
            }
        self.w = {k: np.array(weights[k], np.float32) for k in self.NAMES}

    def inputs(self) -> np.ndarray:
        """What each word adds to the gates and the candidate, three rows a word; the gates' are negated, as in `recurrence`."""
        own = self.w["embed"] + self.w["bias"]
        np.negative(own[:, : 2 * STATE], out=own[:, : 2 * STATE])
        return own.reshape(-1, STATE)

    def recurrence(self) -> np.ndarray:
        """What the state adds to the negated gates and to the candidate, as (3, STATE, STATE)."""
        recur = self.w["recur"].reshape(STATE, 3, STATE).swapaxes(0, 1).copy()
        np.negative(recur[:2], out=recur[:2])
        return recur

    @staticmethod
    def step(own: np.ndarray, h: np.ndarray, recur: np.ndarray, rec: np.ndarray, gates: np.ndarray, c: np.ndarray, new: np.ndarray):
        """One word of every lane, into the last four: the state's share, reset and update gates, candidate, new state."""
        np.matmul(h, recur, out=rec)
        np.add(own[:2], rec[:2], out=gates)
        np.exp(gates, out=gates)
        gates += 1
        np.reciprocal(gates, out=gates)
        np.multiply(gates[0], rec[2], out=c)
        c += own[2]
        np.tanh(c, out=c)
        np.subtract(c, h, out=new)
        new *= gates[1]
        new += h

    def learn(self, name: str, gradient: np.ndarray, memory: np.ndarray, rows: np.ndarray | slice = slice(None)) -> None:
        """An adaptive step down the gradient of some rows of a weight, kept within BOUND."""
        g = np.clip(gradient, -1, 1)
        held = g * g
        held += memory[rows]
        memory[rows] = held
        held += np.float32(DAMPING)
        np.sqrt(held, out=held)
        g *= np.float32(RATE)
        g /= held
        np.subtract(self.w[name][rows], g, out=g)
        self.w[name][rows] = np.clip(g, -BOUND, BOUND, out=g)

    def output(self, h: np.ndarray, kind: np.ndarray, within: np.ndarray, backward: bool = False):
        """Log probabilities of class and word for each state; with `backward`, gradients too."""
        w = self.w
        e = np.empty((len(h) if backward else min(len(h), ROWS), self.kinds), np.result_type(h, w["to_class"]))
        got, row = np.empty(len(h), e.dtype), np.arange(len(h))
        # Some states at a time, so that their classes stay in the processor's cache from call to call.
        for at in range(0, len(h), ROWS):
            some = slice(at, min(at + ROWS, len(h)))
            part = e[some] if backward else e[: some.stop - at]
            own = row[: len(part)] * self.kinds + kind[some]
            np.matmul(h[some], w["to_class"], out=part)
            part += w["class_bias"]
            got[some] = part.reshape(-1)[own]
            np.exp(part, out=part)
            norm = part.sum(1)
            got[some] -= np.log(norm)
            if backward:
                part /= norm[:, None]
                part.reshape(-1)[own] -= 1
        grads = {}
        if backward:
            grads["to_class"], grads["to_word"] = h.T @ e, np.zeros_like(w["to_word"])
            dh = e @ w["to_class"].T
        # The states whose word has weights of its own, class by class.
        order = np.argsort(radix(kind, self.kinds), kind="stable")
        edge = np.searchsorted(kind[order], np.arange(self.classes + 1))
        order = order[: edge[-1]]
        mine, own = np.take(h, order, axis=0), row[: len(order)] * CLASS_SIZE + within[order]
        parts = [(k, slice(edge[k], edge[k + 1])) for k in np.flatnonzero(np.diff(edge))]
        e = np.empty((len(order), CLASS_SIZE), np.result_type(h, w["to_word"]))
        for k, at in parts:
            np.matmul(mine[at], w["to_word"][k], out=e[at])
            e[at] += w["word_bias"][k]
        chosen = e.reshape(-1)[own]
        np.exp(e, out=e)
        norm = e.sum(1)
        chosen -= np.log(norm)
        got[order] += chosen
        if backward:
            e /= norm[:, None]
            e.reshape(-1)[own] -= 1
            more = np.empty_like(mine)
            for k, at in parts:
                np.matmul(mine[at].T, e[at], out=grads["to_word"][k])
                np.matmul(e[at], w["to_word"][k].T, out=more[at])
            more += np.take(dh, order, axis=0)
            dh[order] = more
        return (got, grads, dh) if backward else got


def row_sums(values: np.ndarray, order: np.ndarray, start: np.ndarray) -> np.ndarray:
    """`np.add.reduceat(values[order], start)` to the bit, for groups that are mostly of a few rows.

    Groups of up to SHORT rows are summed side by side, a row of each at a time; `reduceat` goes column by column.
    """
    size = np.diff(start, append=len(order))
    by_size = np.argsort(radix(size, len(order) + 1), kind="stable")
    begin, size = start[by_size], size[by_size]
    least = np.searchsorted(size, np.arange(SHORT + 2))  # the first group of at least so many rows
    sums = np.empty((len(start), values.shape[1]), values.dtype)
    short, long = by_size[: least[-1]], by_size[least[-1] :]
    # The first row is added last, to the sum of the others.
    total = np.take(values, order[begin[: len(short)]], axis=0)
    if least[2] < len(short):
        rest = np.take(values, order[begin[least[2] : len(short)] + 1], axis=0)
        for k in range(3, SHORT + 1):
            rest[least[k] - least[2] :] += np.take(values, order[begin[least[k] : len(short)] + k - 1], axis=0)
        total[least[2] :] += rest
    sums[short] = total
    if len(long):
        size = size[len(short) :]
        ends = np.cumsum(size)
        rows = np.arange(ends[-1]) + np.repeat(begin[len(short) :] - ends + size, size)
        sums[long] = np.add.reduceat(np.take(values, order[rows], axis=0), ends - size)
    return sums


def lanes(lengths: np.ndarray, width: int) -> list[list[int]]:
    """Documents dealt to lanes, longest first, each to the shortest lane."""
    import heapq

    out: list[list[int]] = [[] for _ in range(width)]
    heap = [(0, k) for k in range(width)]
    for d in np.argsort(-lengths, kind="stable"):
        n, k = heapq.heappop(heap)
        out[k].append(int(d))
        heapq.heappush(heap, (n + int(lengths[d]), k))
    return [lane for lane in out if lane]


class Reader:
    """Documents side by side: inputs, targets and starts, as (steps, lanes) arrays."""

    def __init__(self, v: Vocabulary, words: np.ndarray, counts: np.ndarray, width: int):
        # `words` are the inputs of the words of the texts in order; every document ends with END.
        lengths = counts + 1
        if len(lengths):  # no more lanes than the longest document lets be full
            width = max(1, min(width, -(-int(lengths.sum()) // int(lengths.max()))))
        starts = np.r_[0, np.cumsum(counts)[:-1]] if len(counts) else counts
        dealt = lanes(lengths, width)
        self.steps = max((sum(int(lengths[d]) for d in lane) for lane in dealt), default=0)
        shape = (self.steps, len(dealt))
        self.doc = np.full(shape, -1, np.int32)
        seen = np.zeros(shape, np.int32)
        self.first = np.zeros(shape, bool)
        end = v.end if v.end < v.neural else v.neural + spelt_class(END)
        for lane, members in enumerate(dealt):
            at = 0
            for d in members:
                n, s = int(counts[d]), int(starts[d])
                seen[at : at + n, lane] = words[s : s + n]
                seen[at + n, lane] = end
                self.doc[at : at + n + 1, lane] = d
                self.first[at, lane] = True
                at += n + 1
        own, spelt = np.arange(v.neural, dtype=np.int32), np.arange(SPELT, dtype=np.int32)
        self.kind = np.take(np.r_[own // CLASS_SIZE, np.int32(v.classes) + spelt], seen)
        self.within = np.take(np.r_[own % CLASS_SIZE, np.zeros_like(spelt)], seen)
        self.begins = self.first.any(1)
        # A document is read from its end mark on: the input before its first word is the mark.
        self.input = np.full(shape, end, np.int32)
        if self.steps:
            self.input[1:] = np.where(self.first[1:], end, seen[:-1])

    def rows(self, at: int, stop: int) -> np.ndarray:
        """The rows of `Network.inputs` of a window's words, (steps, 3, lanes)."""
        return self.input[at:stop, None] * 3 + np.arange(3)[:, None]

    def real(self, at: int, stop: int, states: np.ndarray):
        """State, kind, place in it and document of each word of a window, and where these are, if not everywhere."""
        doc = self.doc[at:stop].reshape(-1)
        all_of = states.reshape(-1, STATE), self.kind[at:stop].reshape(-1), self.within[at:stop].reshape(-1), doc
        if doc.size == 0 or doc.min() >= 0:
            return *all_of, None
        real = np.flatnonzero(doc >= 0)
        return *(x[real] for x in all_of), real


def read_batch(v: Vocabulary, texts: pa.Array, width: int):
    """The reader of some texts, with the word codes it came from."""
    codes, distinct, counts = tokenised(texts, v.known())
    entries = v.entries(distinct)
    return Reader(v, entries[codes], counts, width), codes, distinct, entries, counts


def neural_scores(network: Network, reader: Reader, documents: int) -> np.ndarray:
    """Natural log probability of each document's classes and neural words, state carried throughout."""
    total, words, recur = np.zeros(documents), network.inputs(), network.recurrence()
    h = np.zeros((reader.doc.shape[1], STATE), np.float32)
    rec, gates, c = (np.empty((n, *h.shape), np.float32) for n in (3, 2, 1))
    for at in range(0, reader.steps, STEPS):
        stop = min(at + STEPS, reader.steps)
        states = np.empty((stop - at, *h.shape), np.float32)
        own = np.take(words, reader.rows(at, stop), axis=0)
        for t in range(at, stop):
            if reader.begins[t]:
                h = np.where(reader.first[t][:, None], np.float32(0), h)
            network.step(own[t - at], h, recur, rec, gates, c[0], states[t - at])
            h = states[t - at]
        flat, kind, within, doc, _ = reader.real(at, stop, states)
        total += np.bincount(doc, network.output(flat, kind, within), documents)
    return total


def train(network: Network, reader: Reader, memory: dict[str, np.ndarray]) -> int:
    """One pass of truncated backpropagation, with adaptive steps; returns the words seen."""
    seen = 0
    h = np.zeros((reader.doc.shape[1], STATE), np.float32)
    for at in range(0, reader.steps, TRAIN_STEPS):
        stop = min(at + TRAIN_STEPS, reader.steps)
        states = np.empty((stop - at, *h.shape), np.float32)
        befores, candidate = np.empty_like(states), np.empty_like(states)
        gates, rec = (np.empty((stop - at, n, *h.shape), np.float32) for n in (2, 3))
        own, recur = np.take(network.inputs(), reader.rows(at, stop), axis=0), network.recurrence()
        for i in range(stop - at):
            if reader.begins[at + i]:
                h = np.where(reader.first[at + i][:, None], np.float32(0), h)
            befores[i] = h
            network.step(own[i], h, recur, rec[i], gates[i], candidate[i], states[i])
            h = states[i]
        flat, kind, within, doc, real = reader.real(at, stop, states)
        _, grads, from_output = network.output(flat, kind, within, True)
        if real is not None:
            dh, from_output = from_output, np.zeros((states.size // STATE, STATE), np.float32)
            from_output[real] = dh
        from_output = from_output.reshape(states.shape)
        # Factors of the gradients that don't depend on later steps, for the whole window.
        keep, of_candidate, moved = 1 - gates, 1 - candidate * candidate, candidate - befores
        d_candidate = np.empty_like(states)
        d_rec = np.empty((stop - at, h.shape[0], 3 * STATE), np.float32)
        back, over = np.zeros_like(h), network.w["recur"].T.copy()
        d_gates, d_last = np.empty((2, *h.shape), np.float32), np.empty_like(h)
        for i in range(stop - 1 - at, -1, -1):
            back += from_output[i]
            d = d_candidate[i]
            np.multiply(back, gates[i, 1], out=d)
            d *= of_candidate[i]
            np.multiply(d, rec[i, 2], out=d_gates[0])
            np.multiply(back, moved[i], out=d_gates[1])
            d_gates *= gates[i]
            d_gates *= keep[i]
            np.multiply(d, gates[i, 0], out=d_last)
            np.concatenate((d_gates[0], d_gates[1], d_last), axis=1, out=d_rec[i])
            back *= keep[i, 1]
            back += d_rec[i] @ over
            if reader.begins[at + i]:
                back[reader.first[at + i]] = 0
        # Gradients of the window's steps are added up at once; of the inputs, only those that occurred.
        d_in = d_rec.copy()
        d_in[:, :, 2 * STATE :] = d_candidate
        d_in, d_rec = d_in.reshape(-1, 3 * STATE), d_rec.reshape(-1, 3 * STATE)
        inputs = reader.input[at:stop].reshape(-1)
        order = np.argsort(radix(inputs, len(network.w["embed"])), kind="stable")
        start = np.flatnonzero(np.diff(inputs[order], prepend=-1))
        scale = np.float32(1 / max(1, len(doc)))
        network.learn("embed", row_sums(d_in, order, start) * scale, memory["embed"], inputs[order][start])
        grads |= {"bias": d_in.sum(0), "recur": befores.reshape(-1, STATE).T @ d_rec}
        for k, g in grads.items():
            network.learn(k, g * scale, memory[k])
        seen += len(doc)
    return seen


WEIGHTS = "part bigint, name string, n bigint, value binary"


def _merge(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """The mean of some shards' weights, by words seen."""
    rows = rows.sort_values("part")
    n = rows["n"].to_numpy(float)
    value = sum(k * np.frombuffer(v, "<f4").astype(float) for k, v in zip(n, rows["value"])) / n.sum()
    return pd.DataFrame(
        {"part": [key[1] if len(key) > 1 else 0], "name": [key[0]], "n": [int(n.sum())], "value": [value.astype("<f4").tobytes()]}
    )


def train_round(docs: DataFrame, vocabulary, weights, number: int, shards: int) -> dict[str, tuple[int, np.ndarray]] | None:
    """Words seen and averaged weights after one round over that round's share of the documents."""
    tasks, text = min(shards, shuffle_partitions(docs.sparkSession)), F.coalesce("text", F.lit(""))
    hashed = F.xxhash64(F.lit("share"), "doc_id", text)
    own = (
        docs.where(~held_out(F.col("doc_id")) & (F.pmod(hashed, F.lit(ROUNDS)) == number))
        .select(F.pmod(F.xxhash64(hashed), F.lit(shards)).alias("shard"), "doc_id", hashed.alias("hashed"), "text")
        .repartitionById(tasks, F.pmod("shard", F.lit(tasks)).cast("int"))
        .sortWithinPartitions("shard", "doc_id", "hashed")
        .select("shard", "text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v, schema = vocabulary.value, arrow_schema(WEIGHTS)
        for shard, texts in by_shard(batches, PIECE):
            network, seen = Network(v, weights.value), 0
            memory = {k: np.zeros_like(x) for k, x in network.w.items()}
            for part in texts:
                seen += train(network, read_batch(v, part, TRAIN_LANES)[0], memory)
            rows = [(shard, k, seen, x.astype("<f4").tobytes()) for k, x in network.w.items()]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    means = materialised(own.mapInArrow(run, schema_of(WEIGHTS)))
    parts = means.agg(F.max("part")).first()[0]
    if parts is None:
        return None
    for _ in range(max(1, math.ceil(math.log(parts + 1, PARTIAL) - 1e-9))):
        # Some shards at a time, so that no group grows with the table.
        means = means.groupBy("name", F.expr(f"part div {PARTIAL}").alias("p")).applyInPandas(_merge, schema_of(WEIGHTS))
    return {r["name"]: (r["n"], np.frombuffer(r["value"], "<f4")) for r in means.collect()}


def by_shard(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[int, Iterator[pa.Array]]]:
    """(shard, its texts in pieces of about `size` bytes) of a stream of (shard, text) sorted by shard.

    Pieces depend on the shard's texts only, not on the stream's batches.
    """

    def rows():
        for batch in batches:
            shard = batch.column(0).to_numpy()
            length = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy()
            for a, b in itertools.pairwise([0, *(np.flatnonzero(np.diff(shard)) + 1).tolist(), len(shard)]):
                if b > a:
                    yield int(shard[a]), batch.column(1).slice(a, b - a), length[a:b]

    def texts(runs):
        held, total = [], 0
        for _, part, length in runs:
            at = 0
            while at < len(part):
                ends = total + np.cumsum(length[at:])
                n = int(np.searchsorted(ends, size)) + 1
                if n > len(ends):
                    held.append(part.slice(at))
                    total = int(ends[-1])
                    break
                held.append(part.slice(at, n))
                yield pa.concat_arrays(held)
                held, total, at = [], 0, at + n
        if held:
            yield pa.concat_arrays(held)

    for shard, runs in itertools.groupby(rows(), key=lambda r: r[0]):
        yield shard, texts(runs)


def fit(docs: DataFrame, vocabulary, v: Vocabulary) -> dict[str, np.ndarray]:
    """The weights after all rounds."""
    context = docs.sparkSession.sparkContext
    weights = Network(v).w
    shards = max(1, round(v.total / ROUNDS / SHARD_WORDS))
    for number in range(ROUNDS):
        got = train_round(docs, vocabulary, context.broadcast(weights), number, shards)
        if got is not None:
            weights = {k: mixed(x, *got[k]) for k, x in weights.items()}
    return weights


def mixed(before: np.ndarray, n: int, after: np.ndarray) -> np.ndarray:
    """The new weights, drawn towards the old ones as if those came from PRIOR_WORDS words: what few
    words say of the context counts for little, and the untrained model is the unigram one."""
    return before + (after.reshape(before.shape) - before) * (n / (n + PRIOR_WORDS))


SCORED = "row bigint, doc_id bigint, n_tokens bigint, n_known bigint, logs double, neural double, rare array<binary>, times array<int>"


def score(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score for every row."""
    rows = id_and_text(docs)
    counted = materialised(count_words(rows))
    v = build_vocabulary(counted)
    context = docs.sparkSession.sparkContext
    vocabulary = context.broadcast(v)
    weights = context.broadcast(fit(rows, vocabulary, v))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        schema, known = arrow_schema_scored(), vocabulary.value
        network = Network(known, weights.value)
        outside = len(known.words)
        row = TaskContext.get().partitionId() << 33
        head_log = np.log10(known.counts + SMOOTH)
        # What a word of the head adds to its class's probability: nothing if it has weights of its own.
        inner = head_log - np.log10(known.spelt_sums[np.maximum(known.kind - known.classes, 0)])
        inner[: known.neural], inner[outside] = 0, 0
        end, rare_class = known.end, np.log10(known.spelt_sums)
        end_log, head_log[outside] = head_log[end], 0
        for batch in batches:
            for part in text_pieces(batch, PIECE):
                reader, codes, distinct, entries, counts = read_batch(known, part.column(1), LANES)
                docs_n = part.num_rows
                natural = neural_scores(network, reader, docs_n)
                owner, at = np.repeat(np.arange(docs_n), counts), np.minimum(codes, outside)
                rare = np.flatnonzero(at == outside)
                rare_owner, rare_codes = owner[rare], codes[rare]
                logs = np.bincount(owner, head_log[at], docs_n) + end_log
                neural = natural / np.log(10) + np.bincount(owner, inner[at], docs_n) + inner[end]
                neural -= np.bincount(rare_owner, rare_class[entries[rare_codes] - known.neural], docs_n)
                in_head = counts - np.bincount(rare_owner, minlength=docs_n) + (known.counts[end] > 0)
                # Rare words once for each document, with how often.
                pair = rare_owner.astype(np.int64) * len(distinct) + rare_codes
                pair, times = np.unique(pair, return_counts=True)
                offsets = np.r_[0, np.cumsum(np.bincount(pair // max(1, len(distinct)), minlength=docs_n))].astype(np.int32)
                names = distinct.take(pa.array(pair % max(1, len(distinct))))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(row + np.arange(docs_n)),
                        part.column(0).cast(pa.int64()),
                        pa.array(counts + 1, pa.int64()),
                        pa.array(in_head, pa.int64()),
                        pa.array(logs),
                        pa.array(neural),
                        pa.ListArray.from_arrays(pa.array(offsets), names),
                        pa.ListArray.from_arrays(pa.array(offsets), pa.array(times.astype(np.int32))),
                    ],
                    schema=schema,
                )
                row += docs_n

    scored = materialised(rows.mapInArrow(run, schema_of(SCORED)))
    rare = scored.select("row", F.explode(F.arrays_zip("rare", "times")).alias("r")).select(
        "row", F.col("r.rare").alias("word"), F.col("r.times").alias("times")
    )
    # Only words that training knows need their count; those of the head are no rare words.
    found = (
        rare.join(counted.select("word", "c"), "word", "left")
        .groupBy("row")
        .agg(
            F.sum(F.col("times") * F.log10(F.coalesce("c", F.lit(0)) + F.lit(SMOOTH))).alias("rare_logs"),
            F.sum(F.when(F.col("c") > 0, F.col("times")).otherwise(0)).alias("rare_known"),
        )
        .withColumnRenamed("row", "r")
    )
    joined = scored.drop("rare", "times").join(found, F.col("row") == F.col("r"), "left")
    more = F.coalesce("rare_logs", F.lit(0.0))
    norm = float(np.log10(v.total + SMOOTH * (v.distinct + 1)))
    return joined.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "n_tokens",
        (F.col("n_known") + F.coalesce("rare_known", F.lit(0))).cast("bigint").alias("n_known"),
        F.lit(v.total).cast("bigint").alias("train_tokens"),
        (F.col("logs") + more - F.col("n_tokens") * F.lit(norm)).alias("base_score"),
        (F.col("neural") + more).alias("score"),
    )


def arrow_schema_scored() -> pa.Schema:
    return pa.schema(
        [
            ("row", pa.int64()), ("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
            ("logs", pa.float64()), ("neural", pa.float64()), ("rare", pa.list_(pa.binary())), ("times", pa.list_(pa.int32())),
        ]
    )
