"""Personal data by weak supervision.

Strict patterns with checks give the base spans. Wider patterns give further candidates: written-out
addresses, phone numbers without a plus, card numbers with other separators, long IP addresses.
Strict matches that fail their check give their parts: card numbers inside a run of digits, the front of a
phone run that goes on into something else.
Labelers vote on every candidate, for, against or not at all: the strict pattern with its check, a
gazetteer (known endings, issuer and country prefixes, reserved ranges), the words in front, and
the characters around. Expectation-maximisation over the counts of vote patterns estimates how far
each labeler can be relied on and how likely each pattern is personal data; those likelihoods are
the labels from which a logistic classifier over votes and shape is trained. It decides on the
candidates that are not base spans.

Everything on rows is column expressions. The driver sees counts per vote pattern and shape only,
whose number is fixed by the labelers, not by the data.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import lower_ascii, query, table, text_of

KINDS = ("email", "ip", "card", "phone")

# A run is entered at its first character or where the last match ended, and left only whole:
# the same matches as the plain patterns, in time linear in the text, without deep recursion.
STRICT = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
WIDE = {
    # Marks in brackets go with dots or bracketed dots, the plain word "at" with "dot" only.
    "email": (
        r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+(?:"
        r" ?(?:@|\(at\)|\[at\]) ?[A-Za-z0-9-]{1,63}+(?:(?:\.| ?\(dot\) ?| ?\[dot\] ?)[A-Za-z0-9-]{1,63}+){1,8}+"
        r"| at [A-Za-z0-9-]{1,63}+(?: dot [A-Za-z0-9-]{1,63}+){1,8}+)"
    ),
    "ip": r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])",
    "card": r"(?<![0-9./_])[0-9]{4}([./_])[0-9]{4,6}\1[0-9]{4,5}(?:\1[0-9]{1,7})?(?![0-9./_])",
    "phone": r"(?<![0-9A-Za-z+.)(-])(?:00[1-9][0-9]{0,2}[ .-])?\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9A-Za-z-])",
}
# Cheap tests that every text with a match passes.
STRICT_HINT = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20-]?[0-9]", "phone": r"\+[0-9]"}
WIDE_HINT = {
    "email": r"[(\[]at[)\]]| at [A-Za-z0-9-]+ dot |@",
    "ip": r"[0-9A-Fa-f]:[0-9A-Fa-f]",
    "card": r"[0-9]{4}[./_][0-9]{4}",
    "phone": r"[0-9]{3}\)?[ .-][0-9]{3}[ .-]",
}

# Words in front of a candidate that speak for its kind, and such that speak against any kind.
CONTEXT = {
    "email": r"\b(?:e-?mails?|mail|contact|write to|reach)\b",
    "ip": r"\b(?:ip|address|host|client|server|from|login)\b",
    "card": r"\b(?:card|credit|debit|visa|mastercard|amex|payment|pay)\b",
    "phone": r"\b(?:phone|tel|telephone|call|mobile|cell|fax|whatsapp|contact)\b",
}
AGAINST = r"\b(?:version|ver|isbn|issn|doi|order|invoice|serial|sku|part|fig|figure|section|chapter|page|build)\b"
CONTEXT_CHARS = 40

GAZETTEER = {
    # Common top-level domains, at the end.
    "email": r"(?i)[. ](?:com|org|net|edu|gov|info|io|co|de|fr|es|uk|eu|us|ch|at|it|nl)$",
    # Private, loopback and link-local ranges tell of machines; the rest of hosts with people behind.
    "ip": r"^(?!(?:0|127|255)\.)[0-9A-Fa-f]",
    # Issuer prefixes of payment cards.
    "card": r"^(?:4|5[1-5]|2[2-7]|3[47]|6011|65|35)",
    # Country codes in front, or a leading area code.
    "phone": r"^(?:\+|00)?(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])|^\(?[2-9][0-9]{2}\)?",
}
# A part of a run that is written as a card is, in one group or the usual ones; others may pass their check by chance.
CARD_GROUPS = r"^(?:[0-9]{13,19}|[0-9]{4}([\x20-])[0-9]{4}\1[0-9]{4}\1[0-9]{1,7}|[0-9]{4}([\x20-])[0-9]{6}\2[0-9]{5})$"
# Digits of a card and of a phone number at most, and so many groups of digits.
MOST_CARD, MOST_PHONE = 19, 15
SHAPES = 3
ROUNDS = 50


@dataclass(frozen=True)
class Model:
    """Weights per kind of the final classifier: bias, then one per vote, then one per shape class."""

    weights: dict[str, tuple[float, ...]]

    def keeps(self, kind: str, votes: Sequence[Column], shape: Column) -> Column:
        w = self.weights.get(kind)
        if w is None:
            return F.lit(False)
        score = F.lit(w[0])
        for weight, vote in zip(w[1:], votes):
            score = score + F.lit(weight) * vote
        for n, weight in enumerate(w[1 + len(votes) :]):
            score = score + F.when(shape == n, F.lit(weight)).otherwise(F.lit(0.0))
        return score >= 0


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    places = F.sequence(F.lit(1), F.greatest(F.char_length(digits), F.lit(1)))
    back = F.reverse(digits)

    def add(total: Column, i: Column) -> Column:
        d = F.coalesce(F.try_to_number(F.substring(back, i, F.lit(1)), F.lit("9")).cast("int"), F.lit(0))
        doubled = d * 2
        return total + F.when(i % 2 == 1, d).when(doubled > 9, doubled - 9).otherwise(doubled)

    return (F.char_length(digits) > 0) & (F.aggregate(places, F.lit(0), add) % 10 == 0)


def _valid(kind: str, value: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return F.forall(
            F.split(value, r"\."), lambda p: F.coalesce(p.try_cast("int") <= 255, F.lit(False))
        )
    digits = _digits(value)
    if kind == "card":
        return F.char_length(digits).between(13, 19) & luhn(digits)
    return F.char_length(digits).between(9, 15)


SPAN = "array<struct<start:int,end:int,value:string>>"


def _matches(text: Column, pattern: str, hint: str) -> Column:
    """All matches with their places in code points: the lengths of the pieces between them add up."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.split(text, pattern, -1)
    none = F.struct(F.lit(0).alias("at"), F.array().cast(SPAN).alias("spans"))

    def step(so_far: Column, pair: Column) -> Column:
        start = so_far["at"] + F.char_length(pair["between"])
        end = start + F.char_length(pair["found"])
        span = F.struct(start.alias("start"), end.alias("end"), pair["found"].alias("value"))
        return F.struct(end.alias("at"), F.concat(so_far["spans"], F.array(span)).alias("spans"))

    pairs = F.zip_with(
        found, F.slice(between, F.lit(1), F.size(found)), lambda f, b: F.struct(b.alias("between"), f.alias("found"))
    )
    spans = F.aggregate(pairs, none, step, lambda so_far: so_far["spans"])
    return F.when(text.rlike(hint), spans).otherwise(F.array().cast(SPAN))


def base_spans(text: Column, kind: str) -> Column:
    """Leftmost matches of the strict pattern, without those that fail the kind's check."""
    return F.filter(_matches(text, STRICT[kind], STRICT_HINT[kind]), lambda s: _valid(kind, s["value"]))


def _votes(text: Column, kind: str, span: Column, strict: bool, part: bool = False) -> tuple[list[Column], Column]:
    """Votes of the four labelers, 1, 0 or -1, and the shape class of a candidate."""
    value = span["value"]
    before = lower_ascii(
        F.substring(text, F.greatest(span["start"] - CONTEXT_CHARS + 1, F.lit(1)), F.least(span["start"], F.lit(CONTEXT_CHARS)))
    )
    if strict:
        pattern = F.when(_valid(kind, value), 1).otherwise(-1)
    elif part:
        pattern = F.when(value.rlike(CARD_GROUPS), 1).otherwise(0) if kind == "card" else F.lit(1)
    elif kind == "card":
        pattern = F.when(_valid(kind, value), 0).otherwise(-1)
    else:
        pattern = F.lit(0)
    gazetteer = F.when(value.rlike(GAZETTEER[kind]), 1).otherwise(-1)
    context = F.when(before.rlike(AGAINST), -1).when(before.rlike(CONTEXT[kind]), 1).otherwise(0)
    beside = F.concat(
        F.when(span["start"] > 0, F.substring(text, span["start"], F.lit(1))).otherwise(F.lit(" ")),
        F.substring(text, span["end"] + 1, F.lit(1)),
    )
    around = F.when(beside.rlike("[A-Za-z0-9]"), -1).otherwise(1)
    length = F.char_length(value)
    shape = F.when(length < 12, 0).when(length < 20, 1).otherwise(2)
    return [pattern, gazetteer, context, around], shape


def _overlap(a: Column, b: Column) -> Column:
    return (a["start"] < b["end"]) & (b["start"] < a["end"])


def _piece(run: Column, start: Column, end: Column) -> Column:
    """The span of a run's characters from ``start`` to before ``end``."""
    return F.struct(
        (run["start"] + start).alias("start"),
        (run["start"] + end).alias("end"),
        F.substring(run["value"], start + 1, end - start).alias("value"),
    )


def _cards_inside(run: Column) -> Column:
    """Every row of groups of digits in a run that passes the check of cards."""

    def rows(groups: Column) -> Column:
        last = F.size(groups) - 1

        def at(i: Column) -> Column:
            ends = F.sequence(i, F.least(i + MOST_CARD - 1, last))
            pieces = F.transform(ends, lambda j: _piece(run, groups[i]["start"], groups[j]["end"]))
            return F.filter(pieces, lambda s: _valid("card", s["value"]))

        return F.flatten(F.transform(F.sequence(F.lit(0), last), at))

    return F.flatten(F.transform(F.array(_matches(run["value"], "[0-9]++", "[0-9]")), rows))


def _phone_in_front(run: Column, others: Column) -> Column:
    """The longest front of a run that passes the check of phones and meets none of the other spans."""

    def fronts(groups: Column) -> Column:
        ends = F.slice(groups, F.lit(1), F.lit(MOST_PHONE))
        pieces = F.transform(ends, lambda g: _piece(run, F.lit(0), g["end"]))
        fit = F.filter(pieces, lambda s: _valid("phone", s["value"]) & ~F.exists(others, lambda o: _overlap(s, o)))
        return F.slice(fit, F.lit(-1), F.lit(1))

    return F.flatten(F.transform(F.array(_matches(run["value"], "[0-9]++", "[0-9]")), fronts))


def _found(docs: DataFrame, own: Sequence[str]) -> DataFrame:
    """The columns ``own`` and ``_text``, with the matches of each kind: ``_strict_*``, ``_base_*`` those that
    pass the check, ``_part_*`` parts of those that fail, ``_wide_*`` wide matches beside base spans and parts."""
    text = F.col("_text")
    none = F.array().cast(SPAN)
    rows = docs.select(*own, text_of("text").alias("_text"))
    rows = rows.select("*", *[_matches(text, STRICT[kind], STRICT_HINT[kind]).alias(f"_strict_{kind}") for kind in KINDS])
    base = lambda kind: F.filter(f"_strict_{kind}", lambda s: _valid(kind, s["value"]))
    rows = rows.select("*", *[base(kind).alias(f"_base_{kind}") for kind in KINDS])
    failed = lambda kind, most: F.filter(
        f"_strict_{kind}", lambda s: (F.char_length(_digits(s["value"])) > most) & ~_valid(kind, s["value"])
    )
    cards = F.flatten(F.transform(failed("card", 12), _cards_inside))
    rows = rows.select("*", cards.alias("_part_card"), none.alias("_part_email"), none.alias("_part_ip"))
    sure = F.filter("_part_card", lambda s: s["value"].rlike(CARD_GROUPS))
    others = F.concat("_base_ip", "_base_card", sure)
    phones = F.flatten(F.transform(failed("phone", MOST_PHONE), lambda run: _phone_in_front(run, others)))
    rows = rows.select("*", phones.alias("_part_phone"))

    def wide(kind: str) -> Column:
        taken = F.concat(f"_base_{kind}", f"_part_{kind}")
        return F.filter(
            _matches(text, WIDE[kind], WIDE_HINT[kind]), lambda w: ~F.exists(taken, lambda s: _overlap(s, w))
        )

    return rows.select("*", *[wide(kind).alias(f"_wide_{kind}") for kind in KINDS])


def _candidates(kind: str) -> Column:
    """Strict matches, failed ones too, their parts and wide matches beside them, with votes and shape."""

    def described(strict: bool, part: bool):
        def of(span: Column) -> Column:
            votes, shape = _votes(F.col("_text"), kind, span, strict, part)
            return F.struct(
                F.lit(kind).alias("kind"),
                F.array(*[v.cast("int") for v in votes]).alias("votes"),
                shape.alias("shape"),
            )

        return of

    return F.concat(
        F.transform(f"_strict_{kind}", described(True, False)),
        F.transform(f"_part_{kind}", described(False, True)),
        F.transform(f"_wide_{kind}", described(False, False)),
    )


def vote_counts(docs: DataFrame) -> DataFrame:
    """``(kind, votes, shape, n)`` over the candidates of all texts."""
    every = F.concat(*[_candidates(kind) for kind in KINDS])
    return (
        _found(docs, ()).select(F.explode(every).alias("c"))
        .groupBy(F.col("c.kind").alias("kind"), F.col("c.votes").alias("votes"), F.col("c.shape").alias("shape"))
        .agg(F.count("*").alias("n"))
    )


def expectation_maximisation(counts: dict[tuple[int, ...], int], rounds: int = ROUNDS) -> dict[tuple[int, ...], float]:
    """Probability that a candidate with a vote pattern is personal data.

    Each labeler votes 1, 0 or -1 with probabilities of its own for either truth; they start
    from a belief that labelers are mostly right, with one vote of weight behind each value.
    """
    if not counts:
        return {}
    n_labelers = len(next(iter(counts)))
    prior = 0.5
    right = {True: {1: 0.7, 0: 0.2, -1: 0.1}, False: {1: 0.1, 0: 0.2, -1: 0.7}}
    rates = [{truth: dict(right[truth]) for truth in right} for _ in range(n_labelers)]
    belief: dict[tuple[int, ...], float] = {}
    for _ in range(rounds):
        for pattern in counts:
            yes, no = prior, 1 - prior
            for labeler, vote in zip(rates, pattern):
                yes *= labeler[True][vote]
                no *= labeler[False][vote]
            belief[pattern] = yes / (yes + no)
        total = sum(counts.values())
        for_it = sum(belief[p] * n for p, n in counts.items())
        prior = (for_it + 1) / (total + 2)
        for j, labeler in enumerate(rates):
            for truth, mass in ((True, for_it), (False, total - for_it)):
                for vote in (1, 0, -1):
                    seen = sum(
                        n * (belief[p] if truth else 1 - belief[p]) for p, n in counts.items() if p[j] == vote
                    )
                    start = right[truth][vote]
                    labeler[truth][vote] = (seen + 3 * start) / (mass + 3)
    return belief


def train_classifier(rows: list[tuple[tuple[int, ...], int, int, float]], rounds: int = 300) -> tuple[float, ...]:
    """Logistic weights from ``(votes, shape, n, probability)`` by gradient descent with a small penalty."""
    width = 1 + len(rows[0][0]) + SHAPES
    features = [
        (1.0, *map(float, votes), *[1.0 if shape == s else 0.0 for s in range(SHAPES)]) for votes, shape, _, _ in rows
    ]
    # Rare patterns count too: weights grow with the logarithm of how often one was seen.
    mass = [math.log1p(n) for _, _, n, _ in rows]
    w = [0.0] * width
    for _ in range(rounds):
        slope = [0.001 * x for x in w]
        for x, m, (_, _, _, p) in zip(features, mass, rows):
            miss = 1 / (1 + math.exp(-max(-30.0, min(30.0, sum(a * b for a, b in zip(w, x)))))) - p
            for j, value in enumerate(x):
                slope[j] += m * miss * value / sum(mass)
        w = [a - 1.0 * b for a, b in zip(w, slope)]
    return tuple(w)


def fit(docs: DataFrame) -> Model:
    """Reliabilities and classifier from all texts. At most kinds x 3^4 x shapes rows are collected."""
    rows = vote_counts(docs).collect()
    weights = {}
    for kind in KINDS:
        own = [(tuple(r["votes"]), r["shape"], r["n"]) for r in sorted(rows, key=lambda r: (r["kind"], r["votes"], r["shape"])) if r["kind"] == kind]
        if not own:
            continue
        counts: dict[tuple[int, ...], int] = {}
        for votes, _, n in own:
            counts[votes] = counts.get(votes, 0) + n
        belief = expectation_maximisation(counts)
        weights[kind] = train_classifier([(votes, shape, n, belief[votes]) for votes, shape, n in own])
    return Model(weights)


def with_spans(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` with ``base`` and ``spans``: ``array<struct<kind, start, end>>`` by kind, then start.

    ``spans`` are the base spans and the further candidates the classifier keeps. Places are code
    points, ends are exclusive. Null and empty texts have no spans. Columns of the two names are
    replaced, others pass through.
    """
    text = F.col("_text")

    def named(kind: str, spans: Column) -> Column:
        return F.transform(
            spans, lambda s: F.struct(F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end"))
        )

    def added(kind: str) -> Column:
        def keeps(part: bool):
            def of(span: Column) -> Column:
                votes, shape = _votes(text, kind, span, False, part)
                return model.keeps(kind, votes, shape)

            return of

        return F.concat(F.filter(f"_part_{kind}", keeps(True)), F.filter(f"_wide_{kind}", keeps(False)))

    own = [c for c in docs.columns if c not in ("base", "spans")]
    made = _found(docs, own).select(
        *own,
        *[f"_base_{kind}" for kind in KINDS],
        *[(added(kind) if kind in model.weights else F.array().cast(SPAN)).alias(f"_more_{kind}") for kind in KINDS],
    )
    return made.select(
        *own,
        F.concat(*[named(kind, F.col(f"_base_{kind}")) for kind in KINDS]).alias("base"),
        F.concat(
            *[
                F.array_sort(F.concat(named(kind, F.col(f"_base_{kind}")), named(kind, F.col(f"_more_{kind}"))))
                for kind in KINDS
            ]
        ).alias("spans"),
    )


def redact(text: Column, spans: Column) -> Column:
    """The text with ``<KIND>`` in place of each span; of spans that overlap, the first one's kind stands."""
    ordered = F.array_sort(
        F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))
    )
    none = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))

    def step(so_far: Column, s: Column) -> Column:
        fresh = s["start"] >= so_far["at"]
        return F.struct(
            F.when(
                fresh,
                F.concat(
                    so_far["out"],
                    F.substring(text, so_far["at"] + 1, s["start"] - so_far["at"]),
                    F.lit("<"), F.upper(s["kind"]), F.lit(">"),
                ),
            )
            .otherwise(so_far["out"])
            .alias("out"),
            F.greatest(so_far["at"], s["end"]).alias("at"),
        )

    cut = F.aggregate(
        ordered, none, step, lambda so_far: F.concat(so_far["out"], F.substring(text, so_far["at"] + 1, F.char_length(text)))
    )
    return F.when(text.isNull() | (F.size(spans) == 0), text).otherwise(cut)


def listed(spans: Column) -> Column:
    return F.array_join(
        F.transform(
            spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
        ),
        ",",
    )


@query("op4_weak_pii")
def op4_weak_pii(spark, sf_dir):
    """Personal data in every document: base spans per kind, and all spans."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = with_spans(docs, fit(docs)).drop("text")
    of_kind = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id",
        *[of_kind(kind).alias(f"n_{kind}") for kind in KINDS],
        F.sha2(listed(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    )
