"""Personal data by weak supervision (operator 10); Spark expressions only.

Base patterns find emails, IP addresses, card and phone numbers. Looser patterns propose further
candidates of the same kinds. Labelers vote yes, no or nothing on every candidate: the strict pattern
with its checks, a gazetteer (top-level domains, card issuers, dialling codes), the shape of the
candidate, and the words before it. Candidates are counted by kind and votes; expectation-maximisation
over those counts (a table of bounded size) estimates how reliable each labeler is and how likely each
pattern of votes, and a logistic span classifier is fitted on the result. Its probabilities go back
into the query as a literal map. Base spans always stay; a loose candidate is added if the classifier
finds it more likely than ADD_FROM and no base span overlaps it.

Positions are code points. A matched text is set between marker characters and split there, which
gives positions without leaving the JVM; a text's own marker characters are replaced by another control
character first, of the same length, that no pattern matches.

Defined cases: null text counts as empty; texts without digits or signs give no spans; repeated rows
are rows; null ids are kept; an empty table gives no rows; other columns don't matter.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from molspark.llm.common import id_and_text

KINDS = ("email", "ip", "card", "phone")
ADD_FROM = 0.9
EM_ROUNDS = 50
BLOCK = 64  # parts whose lengths are added up at once
CONTEXT = 48  # code points before a candidate in which cue words are looked for

# What each pattern must match. Possessive forms match the same texts in linear time; an
# email starts at the start of a run of its characters, or where the match before it has ended.
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
LOOSE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++ ?(?:\(at\)|\[at\]) ?[A-Za-z0-9-]++(?: ?(?:\.|\(dot\)|\[dot\]) ?[A-Za-z0-9-]++)++",
    "phone": r"(?<![0-9+().-])(?:\([0-9]{3}\) ?|[0-9]{3}[.-])[0-9]{3}[.-][0-9]{4}(?![0-9A-Za-z_]|[.-][0-9])",
}
GAZETTEER = {
    "email": r"(?i)(?:\.|dot[)\]] ?)(?:com|org|net|edu|gov|mil|int|info|biz|name|io|co|uk|de|fr|es|it|eu|us|ca|au|ch|at|nl|be|se|no|dk|fi|pl|pt|ie|jp|cn|in|br|mx)$",
    "ip": r"^(?!0|127\.|255\.|22[4-9]\.|2[3-5][0-9]\.)",
    "card": r"^(?:4|5[1-5]|2[2-7]|3[47]|6(?:011|5))",
    "phone": r"^(?:\+(?:1|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|7|8[1246]|9[0-58])|\(?[2-9])",
}
CUES = {
    "email": r"(?i)\b(?:e-?mails?|mail|contact|write|correo|courriel|reach)\b",
    "ip": r"(?i)\b(?:ip|address|host|server|client|login|adresse|direcci.n)\b",
    "card": r"(?i)\b(?:card|visa|mastercard|amex|credit|debit|payment|karte|carte|tarjeta)\b",
    "phone": r"(?i)\b(?:phone|tel|telephone|call|mobile|cell|fax|telefon|t.l.phone|tel.fono)\b",
}
AGAINST = r"(?i)\b(?:version|release|isbn|order|invoice|figure|section|page|part|serial|sku|no)\b[^A-Za-z]*$"

MARK, OTHER = "\x01", "\x02"
SPAN = "array<struct<start:int,stop:int,text:string,before:string>>"


def _let(value: Column, body) -> Column:
    """`body` of a value that is worked out once, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _total(lengths: Column) -> Column:
    return F.aggregate(lengths, F.lit(0), lambda t, n: t + n)


def spans(text: Column, pattern: str) -> Column:
    """Leftmost non-overlapping matches as (start, stop, text, the code points before).

    Starts are sums of the lengths before: of whole blocks of parts first, then inside a block, so that
    thousands of matches in one text cost little more than as many in several.
    """
    marked = F.regexp_replace(text, f"({pattern})", f"{MARK}$1{MARK}")
    block = F.lit(BLOCK)

    def starts(s: Column) -> Column:
        blocks = F.sequence(F.lit(0), F.floor((F.size(s["lengths"]) - 1) / block).cast("int"))
        sums = F.transform(blocks, lambda b: _total(F.slice(s["lengths"], b * block + 1, block)))
        before = F.aggregate(sums, F.array(F.lit(0)), lambda t, n: F.concat(t, F.array(F.element_at(t, -1) + n)))
        return F.struct(s["parts"].alias("parts"), s["lengths"].alias("lengths"), before.alias("before"))

    def found(s: Column) -> Column:
        def span(i: Column) -> Column:
            own = F.floor(i / block).cast("int")
            at = F.get(s["before"], own) + _total(F.slice(s["lengths"], own * block + 1, i % block))
            return F.struct(
                at.alias("start"),
                (at + F.get(s["lengths"], i)).alias("stop"),
                F.get(s["parts"], i).alias("text"),
                F.right(F.get(s["parts"], i - 1), F.lit(CONTEXT)).alias("before"),
            )

        return F.transform(F.sequence(F.lit(1), F.size(s["parts"]) - 2, F.lit(2)), span)

    cut = _let(
        F.split(marked, MARK, -1),
        lambda parts: F.when(
            F.size(parts) > 1,
            _let(
                _let(F.struct(parts.alias("parts"), F.transform(parts, F.char_length).alias("lengths")), starts),
                found,
            ),
        ).otherwise(F.array().cast(SPAN)),
    )
    return cut


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether the digits pass the Luhn check."""
    at = F.sequence(F.lit(1), F.length(digits))

    def add(total: Column, i: Column) -> Column:
        d = F.substring(F.reverse(digits), i, F.lit(1)).cast("int")
        twice = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return total + F.when(i % 2 == 0, twice).otherwise(d)

    return F.aggregate(at, F.lit(0), add) % 10 == 0


def valid(kind: str, text: Column) -> Column:
    """What a base match must pass."""
    digits = _digits(text)
    if kind == "ip":
        return F.forall(F.split(text, r"\."), lambda p: p.rlike("^0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{0,2})$"))
    if kind == "card":
        return F.length(digits).between(13, 19) & luhn(digits)
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.lit(True)


def votes(kind: str, span: Column, strict: Column) -> Column:
    """The labelers' votes on a candidate as text: 1, 0 or - each."""
    text, before = span["text"], span["before"]
    digits = _digits(text)
    shape = {
        "email": F.char_length(text).between(6, 80),
        "ip": ~text.rlike(r"(?:^|\.)0[0-9]"),
        "card": digits.rlike(r"^([0-9])(?!\1+$)") & ~text.rlike(r"[ -][0-9][ -]"),
        "phone": text.rlike(r"[ ().-]"),
    }[kind]
    glued = before.rlike(r"[A-Za-z0-9_/=#]$")
    return F.concat(
        F.when(strict, "1").otherwise("0"),
        F.when(text.rlike(GAZETTEER[kind]), "1").otherwise("0"),
        F.when(shape, "1").otherwise("0"),
        F.when(before.rlike(AGAINST) | glued, "0").when(before.rlike(CUES[kind]), "1").otherwise("-"),
    )


def _candidates(text: Column, kind: str) -> tuple[Column, Column]:
    """Base spans, and loose candidates: matches of the loose pattern, or card numbers failing a check."""
    found = spans(text, BASE[kind])
    base = F.filter(found, lambda s: valid(kind, s["text"]))
    if kind in LOOSE:
        return base, spans(text, LOOSE[kind])
    if kind == "card":
        return base, F.filter(
            found, lambda s: F.length(_digits(s["text"])).between(13, 19) & ~luhn(_digits(s["text"])) & s["text"].rlike("[ -]")
        )
    return base, F.array().cast(SPAN)


def _voted(group: Column, kind: str, strict: Column) -> Column:
    return F.transform(
        group,
        lambda s: F.struct(s["start"].alias("start"), s["stop"].alias("stop"), votes(kind, s, strict).alias("votes")),
    )


def _numbered(group: Column, number: int) -> Column:
    return F.transform(
        group, lambda s: F.struct(F.lit(number).alias("kind"), s["start"].alias("start"), s["stop"].alias("stop"))
    )


def _of_kind(group: Column, kind: str) -> Column:
    return F.transform(group, lambda s: F.struct(F.lit(kind).alias("kind"), s["votes"].alias("votes")))


def found_spans(docs: DataFrame) -> DataFrame:
    """doc_id and, per kind, base_<kind> and loose_<kind>: spans with the votes on each."""
    text = F.translate(F.coalesce("text", F.lit("")), MARK, OTHER)
    df = id_and_text(docs).select("doc_id", text.alias("text"))
    df = df.withColumn("some", F.col("text").rlike(r"[0-9@]|[(\[]at[)\]]"))
    nothing = F.array().cast("array<struct<start:int,stop:int,votes:string>>")
    columns = []
    for kind in KINDS:
        base, loose = _candidates(F.col("text"), kind)
        for name, group, strict in (("base", base, F.lit(True)), ("loose", loose, F.lit(False))):
            columns.append(F.when(F.col("some"), _voted(group, kind, strict)).otherwise(nothing).alias(f"{name}_{kind}"))
    return df.select("doc_id", *columns)


def vote_counts(found: DataFrame) -> list[tuple[str, str, int]]:
    """(kind, votes, candidates); at most 4 x 2 x 2 x 2 x 3 rows reach the driver."""
    pairs = [
        _of_kind(F.col(f"{name}_{kind}"), kind)
        for kind in KINDS
        for name in ("base", "loose")
    ]
    counted = found.select(F.explode(F.concat(*pairs)).alias("v")).groupBy("v.kind", "v.votes").agg(F.count("*").alias("n"))
    return sorted((r["kind"], r["votes"], r["n"]) for r in counted.collect())


def reliabilities(counts: Sequence[tuple[str, str, int]], rounds: int = EM_ROUNDS) -> dict[tuple[str, str], float]:
    """Probability that a candidate is personal data, by kind and votes: Dawid and Skene's EM.

    Starts from the majority of the votes; sensitivities and false-alarm rates are smoothed towards a
    labeler that is right four times in five, so few candidates don't make a labeler infallible.
    """
    if not counts:
        return {}
    p = {}
    for kind, vote, _ in counts:
        cast = [v for v in vote if v != "-"]
        p[kind, vote] = (cast.count("1") + 0.5) / (len(cast) + 1)
    labelers = range(len(counts[0][1]))
    for _ in range(rounds):
        rate = {}
        share = {k: (sum(n * p[a, v] for a, v, n in counts if a == k) + 1) / (sum(n for a, _, n in counts if a == k) + 2) for k in KINDS}
        for kind in KINDS:
            own = [(v, n, p[kind, v]) for a, v, n in counts if a == kind]
            for i in labelers:
                for truth in (0, 1):
                    weight = lambda q: q if truth else 1 - q  # noqa: B023, E731
                    said = sum(n * weight(q) for v, n, q in own if v[i] == "1")
                    cast = sum(n * weight(q) for v, n, q in own if v[i] != "-")
                    rate[kind, i, truth] = (said + (8 if truth else 2)) / (cast + 10)
        new = {}
        for kind, vote, _ in counts:
            odds = math.log(share[kind] / (1 - share[kind]))
            for i, v in enumerate(vote):
                if v != "-":
                    a, b = rate[kind, i, 1], rate[kind, i, 0]
                    odds += math.log(a / b) if v == "1" else math.log((1 - a) / (1 - b))
            new[kind, vote] = 1 / (1 + math.exp(-max(-40.0, min(40.0, odds))))
        moved = max(abs(new[k] - p[k]) for k in new)
        p = new
        if moved < 1e-9:
            break
    return p


def span_classifier(counts: Sequence[tuple[str, str, int]], p: dict[tuple[str, str], float], rounds: int = 300) -> dict[tuple[str, str], float]:
    """A logistic model of kind and votes fitted on the EM probabilities, weighted by candidates."""

    def features(kind: str, vote: str) -> list[float]:
        return [1.0, *(1.0 if kind == k else 0.0 for k in KINDS), *(0.0 if v == "-" else (1.0 if v == "1" else -1.0) for v in vote)]

    rows = [(features(k, v), p[k, v], math.sqrt(n)) for k, v, n in counts]
    if not rows:
        return {}
    total = sum(n for _, _, n in rows)
    w, speed = [0.0] * len(rows[0][0]), [0.0] * len(rows[0][0])
    say = lambda x: 1 / (1 + math.exp(-max(-40.0, min(40.0, sum(a * b for a, b in zip(w, x))))))
    for _ in range(rounds):
        gradient = [0.001 * a for a in w]
        for x, q, n in rows:
            off = (say(x) - q) * n / total
            gradient = [g + off * a for g, a in zip(gradient, x)]
        speed = [0.9 * s - 0.3 * g for s, g in zip(speed, gradient)]
        w = [a + s for a, s in zip(w, speed)]
    return {(k, v): say(features(k, v)) for k, v, _ in counts}


def detect(docs: DataFrame, add_from: float = ADD_FROM) -> DataFrame:
    """doc_id, base and spans: arrays of (kind number, start, stop), in order, for every row."""
    found = found_spans(docs)
    counts = vote_counts(found)
    likely = span_classifier(counts, reliabilities(counts))
    added = {k: sorted(v for (kind, v), p in likely.items() if kind == k and v[0] == "0" and p >= add_from) for k in KINDS}
    liked = lambda k: lambda s: s["votes"].isin(added[k]) if added[k] else F.lit(False)
    base = found.select(
        "doc_id",
        F.concat(*(_numbered(F.col(f"base_{k}"), i) for i, k in enumerate(KINDS))).alias("base"),
        F.concat(*(_numbered(F.filter(f"loose_{k}", liked(k)), i) for i, k in enumerate(KINDS))).alias("more"),
    )
    more = F.filter(
        "more",
        lambda s: ~F.exists("base", lambda b: (b["start"] < s["stop"]) & (s["start"] < b["stop"])),
    )
    return base.select("doc_id", "base", F.array_sort(F.array_distinct(F.concat("base", more))).alias("spans"))


def listed(spans_: Column) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(
        F.transform(spans_, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["stop"].cast("string"))), ","
    )


def report(docs: DataFrame, add_from: float = ADD_FROM) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256 and spans for every row."""
    found = detect(docs, add_from)
    return found.select(
        "doc_id",
        *(
            F.size(F.filter(F.transform("base", lambda s: s["kind"]), lambda n: n == F.lit(number))).cast("bigint").alias(f"n_{k}")
            for number, k in enumerate(KINDS)
        ),
        F.sha2(listed(F.col("base")), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    )
