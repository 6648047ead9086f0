"""Per-row chemistry as replaceable slots, and a built-in kernel that works on the text alone.

Slots map columns to columns (``descriptors`` adds columns to a frame), so a slot can be a native
expression or a ``pandas_udf`` around a chemistry toolkit. The text kernel below uses native expressions, but for its
portable fingerprint. It checks spelling, not valence, and its products are valid but not canonical.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from operator import add

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Additive:
    """What a kernel promises if its products are sums of their parts.

    A combination of valid parts is possible by the sum of its parts' marks alone, its product is valid
    then, and the product's descriptors are those of its prepared parts added up, and `joint` for each
    fragment. Products of separable parts differ if any part does.
    """

    marks: Callable[[Column], Column]
    possible: Callable[[Column], Column]
    separable: Callable[[Column], Column]
    describe: Callable[[DataFrame, str], DataFrame]
    joint: Mapping[str, float] = field(default_factory=dict)


@dataclass(frozen=True)
class Kernel:
    """The slots a stage may call.

    ``prepare`` runs once per scaffold and once per fragment, before the product is formed.
    ``combine`` gets a prepared scaffold and an array of prepared fragments in label order and
    returns the product text, or null when the combination is impossible.
    """

    is_valid: Callable[[Column], Column]
    n_points: Callable[[Column], Column]
    prepare: Callable[[Column], Column]
    combine: Callable[[Column, Column], Column]
    descriptors: Callable[[DataFrame, str], DataFrame]
    descriptor_names: tuple[str, ...]
    fingerprint: Callable[[Column], Column]
    # Further fingerprints that a graph step may ask for by name.
    fingerprints: Mapping[str, Callable[[Column], Column]] = field(default_factory=dict)
    additive: Additive | None = None


# --- Text validity --------------------------------------------------------------------------

# The possessive quantifier keeps the match iterative, so long texts cannot overflow the stack.
TOKENS = (
    r"^(?:\[[^\[\]]+\]|Br|Cl|[BCNOPSFI]|[bcnops]|\*|[0-9]|%[0-9]{2}|[-=#$:/\\.()])++$"
)
BRACKET = r"\[[^\[\]]*\]"
CLOSURE = r"%[0-9]{2}|[0-9]"


def _count_text(text: Column, part: str) -> Column:
    """Occurrences of one character."""
    return F.length(text) - F.length(F.replace(text, F.lit(part), F.lit("")))


def _bare(text: Column) -> Column:
    """The text without bracket atoms."""
    return F.when(text.contains("["), F.regexp_replace(text, BRACKET, "")).otherwise(text)


def _n_closures(bare: Column) -> Column:
    """Ring-closure labels: each %nn counts once, each other digit once."""
    single = F.when(bare.contains("%"), F.regexp_replace(bare, "%[0-9]{2}", "0")).otherwise(bare)
    return F.length(F.regexp_replace(single, "[^0-9]", ""))


def _branches_match(bare: Column) -> Column:
    """Parentheses that open before they close, and all closed."""
    marks = F.split(F.regexp_replace(bare, "[^()]", ""), "")
    depth = F.aggregate(
        marks,
        F.struct(F.lit(0).alias("now"), F.lit(0).alias("least")),
        lambda d, m: F.struct(
            (d["now"] + F.when(m == "(", 1).when(m == ")", -1).otherwise(0)).alias("now"),
            F.least(d["least"], d["now"] - F.when(m == ")", 1).otherwise(0)).alias("least"),
        ),
    )
    return ~bare.contains("(") & ~bare.contains(")") | (depth["now"] == 0) & (depth["least"] == 0)


def _closures_pair(bare: Column) -> Column:
    """Every ring-closure label opened is closed: each occurs an even number of times."""
    found = F.regexp_extract_all(bare, F.lit(CLOSURE), F.lit(0))
    labels = F.array_sort(F.transform(found, lambda c: F.ltrim(c, F.lit("%")).cast("int")))
    # Sorted, a label's first place is even and its last odd, so neighbours pair up.
    pairs = F.forall(
        F.sequence(F.lit(0), F.size(labels) - 1, F.lit(2)), lambda i: F.get(labels, i) == F.get(labels, i + 1)
    )
    return ~bare.rlike("[0-9]") | (F.size(labels) % 2 == 0) & pairs


def text_is_valid(text: Column) -> Column:
    """Spelled from legal tokens, with matching branches and paired ring closures. Null is false."""
    bare = F.regexp_replace(text, BRACKET, "")
    sound = F.when(text.rlike(TOKENS), _branches_match(bare) & _closures_pair(bare))
    return F.coalesce(sound, F.lit(False))


def text_n_points(text: Column) -> Column:
    """Wildcard atoms, mapped or not."""
    return _count_text(text, "*").cast("int")


# --- Text combination -----------------------------------------------------------------------
# Two dot-separated parts may share a ring-closure label, and that label is then a bond between
# them. Attachment point k therefore becomes closure label 9k with an explicit single bond.

LEADING_POINT = r"^\[\*:([1-9])\](\[[^\]]+\]|Br|Cl|[A-Za-z])"
BRANCH_POINT = r"\(\[\*:([1-9])\]\)"
PLAIN_POINT = r"\[\*:([1-9])\]"
# A label with no atom before it, after a branch or an explicit bond, next to a stereo centre, or
# a wildcard left over.
UNWELDABLE = r"^-%9|[)=#$:/\\]-%9|@[^\[\]]*\]-%9|\*"
MARK_BITS = 6
# Each of the nine labels owns six bits; only the values 0 and 2 have no bit outside 0b10.
MARK_ODD_BITS = reduce(add, (0b111101 << (MARK_BITS * k) for k in range(9)))


def text_prepare(text: Column) -> Column:
    """Turn attachment points into closure labels: ``struct(text, marks)``, null if impossible."""
    welded = F.regexp_replace(text, LEADING_POINT, "$2-%9$1")
    welded = F.regexp_replace(welded, BRANCH_POINT, "-%9$1")
    welded = F.regexp_replace(welded, PLAIN_POINT, "-%9$1")
    marks = reduce(
        add,
        (
            F.shiftleft(F.regexp_count(welded, F.lit(f"%9{k}")).cast("long"), MARK_BITS * (k - 1))
            for k in range(1, 10)
        ),
    )
    usable = ~text.rlike("%9[1-9]") & ~welded.rlike(UNWELDABLE)
    return F.when(usable, F.struct(welded.alias("text"), marks.alias("marks")))


def _marks_pair(marks: Column) -> Column:
    return marks.bitwiseAND(F.lit(MARK_ODD_BITS)) == 0


def text_combine(scaffold: Column, fragments: Column) -> Column:
    """Join the prepared parts; null unless every label occurs exactly twice."""
    marks = F.aggregate(
        fragments, scaffold["marks"], lambda total, fragment: total + fragment["marks"]
    )
    return F.when(_marks_pair(marks), F.concat_ws(".", scaffold["text"], fragments["text"]))


# --- Text descriptors -----------------------------------------------------------------------

# Standard atomic weights.
ATOMIC_WEIGHTS = {
    "H": 1.008, "He": 4.0026, "Li": 6.94, "Be": 9.0122, "B": 10.81, "C": 12.011, "N": 14.007, "O": 15.999,
    "F": 18.998, "Ne": 20.18, "Na": 22.99, "Mg": 24.305, "Al": 26.982, "Si": 28.085, "P": 30.974,
    "S": 32.06, "Cl": 35.45, "Ar": 39.95, "K": 39.098, "Ca": 40.078, "Sc": 44.956, "Ti": 47.867, "V": 50.942,
    "Cr": 51.996, "Mn": 54.938, "Fe": 55.845, "Co": 58.933, "Ni": 58.693, "Cu": 63.546, "Zn": 65.38,
    "Ga": 69.723, "Ge": 72.63, "As": 74.922, "Se": 78.971, "Br": 79.904, "Kr": 83.798, "Rb": 85.468,
    "Sr": 87.62, "Y": 88.906, "Zr": 91.224, "Nb": 92.906, "Mo": 95.95, "Tc": 98.0, "Ru": 101.07, "Rh": 102.91,
    "Pd": 106.42, "Ag": 107.87, "Cd": 112.41, "In": 114.82, "Sn": 118.71, "Sb": 121.76, "Te": 127.6,
    "I": 126.9, "Xe": 131.29, "Cs": 132.91, "Ba": 137.33, "La": 138.91, "Ce": 140.12, "Pr": 140.91,
    "Nd": 144.24, "Pm": 145.0, "Sm": 150.36, "Eu": 151.96, "Gd": 157.25, "Tb": 158.93, "Dy": 162.5,
    "Ho": 164.93, "Er": 167.26, "Tm": 168.93, "Yb": 173.05, "Lu": 174.97, "Hf": 178.49, "Ta": 180.95,
    "W": 183.84, "Re": 186.21, "Os": 190.23, "Ir": 192.22, "Pt": 195.08, "Au": 196.97, "Hg": 200.59,
    "Tl": 204.38, "Pb": 207.2, "Bi": 208.98, "Po": 209.0, "At": 210.0, "Rn": 222.0, "Fr": 223.0, "Ra": 226.0,
    "Ac": 227.0, "Th": 232.04, "Pa": 231.04, "U": 238.03, "Np": 237.0, "Pu": 244.0, "Am": 243.0, "Cm": 247.0,
    "Bk": 247.0, "Cf": 251.0, "Es": 252.0, "Fm": 257.0, "Md": 258.0, "No": 259.0, "Lr": 262.0, "Rf": 267.0,
    "Db": 270.0, "Sg": 271.0, "Bh": 270.0, "Hs": 277.0, "Mt": 278.0, "Ds": 281.0, "Rg": 282.0, "Cn": 285.0,
    "Nh": 286.0, "Fl": 289.0, "Mc": 290.0, "Lv": 293.0, "Ts": 294.0, "Og": 294.0,
}
HALOGENS = ("F", "Cl", "Br", "I")
AROMATIC = ("b", "c", "n", "o", "p", "s", "se", "as", "te")
BRACKET_SYMBOL = r"\[[0-9]*(?:([A-GI-Z][a-z]?|H[efgos]|se|as|te|[bcnops])[^\[\]]*)\]"

TEXT_DESCRIPTORS = (
    "n_heavy_atoms",
    "n_hetero_atoms",
    "n_halogens",
    "n_aromatic_atoms",
    "n_rings",
    "n_branches",
    "heavy_atom_weight",
)


def text_part_descriptors(df: DataFrame, part: str) -> DataFrame:
    """The same of a prepared part, to be added up: a bond between parts is half a ring closure in each."""
    halves = df.withColumn("_text", F.col(part)["text"])
    return text_descriptors(halves, "_text", whole=False).drop("_text")


def text_descriptors(df: DataFrame, text: str, whole: bool = True) -> DataFrame:
    """Append seven numbers read off the text. Their names are not those of the toolkit's.

    Shared intermediate texts are columns of their own, so each is worked out once per row.
    """
    # One capital letter per atom outside brackets: L is chlorine, R is bromine.
    plain = F.replace(F.replace(F.col("_bare"), F.lit("Cl"), F.lit("L")), F.lit("Br"), F.lit("R"))
    symbols = F.when(
        F.col(text).contains("["), F.regexp_extract_all(text, F.lit(BRACKET_SYMBOL), F.lit(1))
    ).otherwise(F.array().cast("array<string>"))
    letters = {"B": "B", "C": "C", "N": "N", "O": "O", "P": "P", "S": "S", "F": "F", "Cl": "L",
               "Br": "R", "I": "I"}
    staged = (
        df.withColumn("_bare", _bare(F.col(text)))
        .withColumn("_atoms", F.regexp_replace(plain, "[^BCNOPSFILRbcnops]", ""))
        .withColumns({"_upper": F.upper("_atoms"), "_symbols": symbols})
        .withColumns(
            {f"_n_{s}": _count_text(F.col("_upper"), letter) for s, letter in letters.items()}
        )
    )

    def inside(wanted: Sequence[str]) -> Column:
        return F.when(
            F.size("_symbols") > 0, F.size(F.filter("_symbols", lambda s: s.isin(*wanted)))
        ).otherwise(F.lit(0))

    known = {**ATOMIC_WEIGHTS, **{s: ATOMIC_WEIGHTS[s.title()] for s in AROMATIC}}
    weights = F.expr("map(%s)" % ", ".join(f"'{s}', {w}D" for s, w in known.items()))
    outside_weight = reduce(add, (F.col(f"_n_{s}") * F.lit(ATOMIC_WEIGHTS[s]) for s in letters))
    inside_weight = F.when(
        F.size("_symbols") > 0,
        F.aggregate("_symbols", F.lit(0.0), lambda total, s: total + weights[s]),
    ).otherwise(F.lit(0.0))
    n_heavy = F.length("_atoms") + F.size("_symbols")
    closures = _n_closures(F.col("_bare"))
    values = {
        "n_heavy_atoms": n_heavy,
        "n_hetero_atoms": n_heavy - F.col("_n_C") - inside(("C", "c")),
        "n_halogens": reduce(add, (F.col(f"_n_{s}") for s in HALOGENS)) + inside(HALOGENS),
        "n_aromatic_atoms": F.length(F.regexp_replace("_atoms", "[A-Z]", "")) + inside(AROMATIC),
        # A closure pair is a ring unless it welds two dot-separated parts together.
        "n_rings": (F.shiftright(closures, 1) if whole else closures / 2) - _count_text(F.col("_bare"), "."),
        "n_branches": _count_text(F.col("_bare"), "("),
        "heavy_atom_weight": outside_weight + inside_weight,
    }
    return staged.withColumns({name: values[name] for name in TEXT_DESCRIPTORS}).drop("_bare", "_atoms", "_upper", "_symbols", *(f"_n_{s}" for s in letters))


# --- Text fingerprint -----------------------------------------------------------------------

# Width of the folded bit set.
FINGERPRINT_BITS = 2048
QGRAM = 4


def qgrams(text: Column, q: int = QGRAM) -> Column:
    """Distinct q-grams of the whole text, found in one linear pass (overlapping matches). A shorter
    text is one gram; the empty text has none."""
    pattern = "(?s)(?=(.{%d}))" % q
    found = F.array_distinct(F.regexp_extract_all(text, F.lit(pattern), F.lit(1)))
    return F.when(F.length(text).between(1, q - 1), F.array(text)).otherwise(found)


def native_hash(gram: Column) -> Column:
    return F.pmod(F.xxhash64(gram), F.lit(1 << 32))


def text_fingerprint(text: Column, q: int = QGRAM, bits: int = FINGERPRINT_BITS) -> Column:
    """Sorted on-bits of the folded q-gram set; null when the text is empty."""
    on = F.transform(qgrams(text, q), lambda g: F.pmod(native_hash(g), F.lit(bits)).cast("int"))
    return F.when(F.length(text) > 0, F.array_sort(F.array_distinct(on)))


# Texts that are hashed at once, by characters and by number; grams whose bit a task remembers.
CHARS_AT_ONCE, TEXTS_AT_ONCE, GRAMS_KNOWN = 1 << 20, 1024, 1 << 18


def _gram_bit(gram: str, bits: int, known: dict[str, int]) -> int:
    """The bit of the first 32 bits of MD5, looked up among the `known` ones first."""
    bit = known.get(gram)
    if bit is None:
        if len(known) >= GRAMS_KNOWN:
            known.clear()
        bit = int.from_bytes(hashlib.md5(gram.encode(), usedforsecurity=False).digest()[:4], "big") % bits
        known[gram] = bit
    return bit


def _gram_codes(points: np.ndarray, q: int) -> tuple[np.ndarray, int]:
    """A number for the q-gram that starts at each of `points` (equal grams, equal numbers), and how many there are."""
    count = len(points) - q + 1
    width = int(points.max()).bit_length() or 1
    key, used = np.zeros(count, dtype=np.uint64), 0
    for j in range(q):
        if used + width > 64:
            codes, found = pd.factorize(key)
            key, used = codes.astype(np.uint64), len(found).bit_length()
        key, used = (key << np.uint64(width)) | points[j : j + count].astype(np.uint64), used + width
    codes, found = pd.factorize(key)
    return codes, len(found)


def _on_bits(texts: Sequence[str], q: int, bits: int, known: dict[str, int]) -> list[np.ndarray]:
    """Sorted on-bits of each text, none of them empty."""
    on = np.zeros((len(texts), bits), dtype=bool)
    for i, text in enumerate(texts):
        if len(text) < q:
            on[i, _gram_bit(text, bits, known)] = True
    joined = "".join(texts)
    if len(joined) >= q:
        sizes = np.array([len(t) for t in texts])
        ends, owner = np.cumsum(sizes), np.repeat(np.arange(len(texts)), sizes)
        codes, found = _gram_codes(np.frombuffer(joined.encode("utf-32-le"), dtype=np.uint32), q)
        starts = np.arange(len(codes))
        # Grams that run over into the next text are none.
        inside = starts + q <= ends[owner[: len(codes)]]
        codes, starts, owner = codes[inside], starts[inside], owner[: len(codes)][inside]
        first = np.full(found, -1)
        first[codes[::-1]] = starts[::-1]
        bit = np.array([0 if a < 0 else _gram_bit(joined[a : a + q], bits, known) for a in first.tolist()])
        on[owner, bit[codes]] = True
    rows, columns = np.nonzero(on)
    return np.split(columns.astype(np.int32), np.searchsorted(rows, np.arange(1, len(texts))))


def portable_fingerprint(text: Column, q: int = QGRAM, bits: int = FINGERPRINT_BITS) -> Column:
    """`text_fingerprint` with the first 32 bits of each gram's MD5, which another engine can reproduce.

    Works on Arrow batches; a gram is hashed once however often a task meets it.
    """

    @F.pandas_udf("array<int>")
    def fingerprint(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known: dict[str, int] = {}
        for batch in batches:
            out: list[np.ndarray | None] = [None] * len(batch)
            held: list[int] = []
            chars = 0
            texts = batch.tolist()
            for i, text in enumerate(texts):
                if text:
                    held.append(i)
                    chars += len(text)
                if held and (chars >= CHARS_AT_ONCE or len(held) >= TEXTS_AT_ONCE or i == len(texts) - 1):
                    for at, on in zip(held, _on_bits([texts[h] for h in held], q, bits, known), strict=True):
                        out[at] = on
                    held, chars = [], 0
            yield pd.Series(out, dtype=object)

    return fingerprint(text)


def text_kernel(portable: bool = False) -> Kernel:
    """The built-in kernel. `portable` hashes fingerprints so that any engine can recompute them."""
    fingerprint = portable_fingerprint if portable else text_fingerprint
    return Kernel(
        is_valid=text_is_valid,
        n_points=text_n_points,
        prepare=text_prepare,
        combine=text_combine,
        descriptors=text_descriptors,
        descriptor_names=TEXT_DESCRIPTORS,
        fingerprint=fingerprint,
        fingerprints={"qgram": fingerprint, "bigram": lambda text: fingerprint(text, q=2)},
        additive=Additive(
            marks=lambda part: part["marks"],
            possible=_marks_pair,
            # The dots between parts tell them apart if no part has one.
            separable=lambda text: ~text.contains("."),
            describe=text_part_descriptors,
            joint={"n_rings": -1.0},
        ),
    )
