"""Personal data [op 1]: labelers vote on candidate spans, expectation-maximisation weighs them, a classifier decides.

1. Candidates are found in whole texts: matches of the base kinds (email, ip, card, phone), those that fail
   their check included, and looser forms (an address spelled with "at" and "dot" in brackets, digits written
   like a phone number without its plus sign).
2. Labelers vote yes, no or nothing on each candidate: its pattern, its check digit or range, a gazetteer of
   mail domains, number prefixes, and words of context before the span.
3. Votes are counted per combination (at most 3 to the power of the number of labelers, times the kinds).
   Expectation-maximisation over these counts estimates how often each labeler is right, without labels.
4. A logistic regression on shape features of the spans is trained on the posteriors, again over counted
   combinations, and decides on the looser candidates. Base spans stay whatever it says.

Positions come from splitting the text by a pattern: matches and the gaps between them alternate. Work is linear in
the length of a text and the number of its spans: positions are running sums taken in chunks, context is read from
blocks of the text, and overlaps are found by binary search. All of it is built-in functions; the driver sees only
counted combinations.

Defined results: a NULL text counts as empty and has no span. Repeated rows are each reported. An empty
table gives an empty result. A NULL ``doc_id`` is kept. Other columns of the input are not looked at.
"""

from __future__ import annotations

import itertools
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ROW, carried, cut, in_blocks, let, packed, running, stored, text_of, unpacked

# Patterns. Possessive quantifiers and the look-behinds change no match; they keep the search linear.
EMAIL = (
    r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
)
IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
IP_PARTS = r"\A0*(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])(?:\.0*(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])){3}\z"
SPELLED_EMAIL = (
    r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]{1,64}+\x20?[\[({]at[\])}]\x20?[A-Za-z0-9-]{1,63}+"
    r"(?:\x20?(?:\.|[\[({]dot[\])}])\x20?[A-Za-z0-9-]{1,63}+){1,8}+"
)
LOCAL_PHONE = r"(?<![0-9+.-])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[.-][0-9]{4}(?![0-9-])"
# Span kinds in the order in which spans are listed; the looser forms count as their kind.
KINDS = ("email", "ip", "card", "phone")
# Gazetteers and words of context; own choice.
MAIL_ENDINGS = ("com", "org", "net", "edu", "gov", "info", "io", "de", "fr", "es", "uk", "eu")
CARD_PREFIXES = ("34", "37", "4", "51", "52", "53", "54", "55", "60", "65")
CONTEXT = {
    "email": ("mail", "contact", "write"),
    "ip": ("ip", "address", "server", "host"),
    "card": ("card", "visa", "mastercard", "payment", "credit"),
    "phone": ("phone", "tel", "call", "mobile", "fax"),
}
CONTEXT_CHARS = 24
# A looser candidate becomes a span at this probability.
DECIDE_AT = 0.9
EM_ROUNDS = 50


def digits_of(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether the check digit is right."""
    reverse = F.transform(F.split(F.reverse(digits), ""), lambda d: F.coalesce(d.try_cast("int"), F.lit(0)))
    doubled = F.transform(
        reverse, lambda d, i: F.when(i % 2 == 1, F.when(d > 4, d * 2 - 9).otherwise(d * 2)).otherwise(d)
    )
    return F.aggregate(doubled, F.lit(0), lambda a, d: a + d) % 10 == 0


def spans_of(text: Column, pattern: str) -> Column:
    """All matches with start and end (code points), as an array of structs (start, end, found)."""

    def placed(gaps: Column, found: Column, ends: Column) -> Column:
        return F.transform(
            found,
            lambda m, i: F.struct(
                (F.get(ends, i) - F.length(m)).alias("start"), F.get(ends, i).alias("end"), m.alias("found")
            ),
        )

    def body(gaps: Column, found: Column) -> Column:
        lengths = F.transform(found, lambda m, i: F.length(F.get(gaps, i)) + F.length(m))
        return let(running(lengths, lambda a, x: a + x), lambda ends: placed(gaps, found, ends))

    return let(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
        lambda found: let(F.split(text, pattern), lambda gaps: body(gaps, found)),
    )


def _where(condition: Column, spans: Column) -> Column:
    """Skips the patterns where a cheap test rules a match out."""
    return F.when(condition, spans).otherwise(F.array().cast("array<struct<start:int,end:int,found:string>>"))


def candidates(docs: DataFrame) -> DataFrame:
    """doc_id, text and ``found``: all candidate spans with kind, base flag, votes and features."""
    text = F.col("text")
    raw = docs.select("doc_id", text_of().alias("text"), *carried(docs)).select("*", text.rlike("[0-9]").alias("_digits"))
    spans = raw.select(
        "*",
        _where(F.instr(text, "@") > 0, spans_of(text, EMAIL)).alias("_email"),
        _where(F.col("_digits"), spans_of(text, IP)).alias("_ip"),
        _where(F.col("_digits"), spans_of(text, CARD)).alias("_card"),
        _where(F.instr(text, "+") > 0, spans_of(text, PHONE)).alias("_phone"),
        _where(text.rlike(r"[\[({]at[\])}]"), spans_of(text, SPELLED_EMAIL)).alias("_spelled"),
        _where(F.col("_digits"), spans_of(text, LOCAL_PHONE)).alias("_local"),
    )
    ordered = [
        ("_email", "email", False),
        ("_ip", "ip", False),
        ("_card", "card", False),
        ("_phone", "phone", False),
        ("_spelled", "email", True),
        ("_local", "phone", True),
    ]
    some = F.greatest(*[F.size(c) for c, _, _ in ordered]) > 0
    blocks = F.when(some, in_blocks(text)).otherwise(F.array().cast("array<string>"))
    everything = let(blocks, lambda b: F.concat(*[_described(F.col(c), kind, loose, b) for c, kind, loose in ordered]))
    return spans.select("doc_id", "text", *carried(docs), everything.alias("found"))


def _described(spans: Column, kind: str, loose: bool, blocks: Column) -> Column:
    """Adds to each span whether it is a base span, the labelers' votes and the classifier's features."""

    def describe(s: Column) -> Column:
        digits = digits_of(s["found"])
        n = F.length(digits)
        before = F.lower(cut(blocks, F.greatest(s["start"] - CONTEXT_CHARS, F.lit(0)), s["start"]))
        near = before.rlike(r"(?:^|[^a-z])(?:" + "|".join(CONTEXT[kind]) + r")[^a-z]")
        ahead = cut(blocks, s["end"], s["end"] + 1)
        glued = ahead.rlike(r"[\p{L}\p{N}]") | before.rlike(r"[\p{L}\p{N}]\z")
        if kind == "email":
            valid = F.lit(not loose)
            gazetteer = F.lower(s["found"]).rlike(r"(?:" + "|".join(MAIL_ENDINGS) + r")\z")
            length = F.when(F.length(s["found"]) <= 40, 1).otherwise(0)
        elif kind == "ip":
            valid = s["found"].rlike(IP_PARTS)
            gazetteer = ~s["found"].rlike(r"\A(?:0|255|127)\.")
            length = F.when(F.length(s["found"]) <= 15, 1).otherwise(0)
        elif kind == "card":
            valid = F.when(n.between(13, 19), luhn(digits)).otherwise(False)
            gazetteer = digits.rlike(r"\A(?:" + "|".join(CARD_PREFIXES) + r")")
            length = F.when(n.between(13, 19), 2).when(n >= 9, 1).otherwise(0)
        else:
            valid = n.between(9, 15) & F.lit(not loose)
            gazetteer = digits.rlike(r"\A(?:1|[2-9][0-9])")
            length = F.when(n.between(9, 15), 1).otherwise(0)
        shape = F.when(s["found"].rlike(r"\A[0-9]+\z"), 0).when(s["found"].rlike(r"[()]"), 1).otherwise(2)
        yes = lambda c: F.when(c, 1).otherwise(-1)
        return F.struct(
            F.lit(kind).alias("kind"),
            s["start"].alias("start"),
            s["end"].alias("end"),
            (valid & F.lit(not loose)).alias("base"),
            F.concat(
                (yes(valid) + 1).cast("string"),  # pattern with its check
                (F.when(gazetteer, 1).otherwise(0) + 1).cast("string"),  # gazetteer: yes or nothing
                (F.when(near, 1).otherwise(0) + 1).cast("string"),  # context: yes or nothing
                (F.when(glued, -1).otherwise(0) + 1).cast("string"),  # glued to a word: no or nothing
                (F.when(length == 0, -1).otherwise(0) + 1).cast("string"),  # unlikely length: no or nothing
            ).alias("votes"),
            F.concat(
                F.lit(str(KINDS.index(kind))),
                F.lit("1" if loose else "0"),
                length.cast("string"),
                shape.cast("string"),
                F.when(valid, "1").otherwise("0"),
                F.when(near, "1").otherwise("0"),
                F.when(glued, "1").otherwise("0"),
                F.when(gazetteer, "1").otherwise("0"),
            ).alias("features"),
        )

    return F.transform(spans, describe)


def reliabilities(counts: dict[tuple[str, str], int]) -> dict[tuple[str, str], float]:
    """Expectation-maximisation over counted votes: the probability of each (kind, votes) to be personal data.

    Labelers are taken as independent given the truth. Each has a chance of every vote (no, nothing, yes)
    under either truth, kept from 0 and 1 by one added count. It starts from the majority of votes.
    """
    believed: dict[tuple[str, str], float] = {}
    for (kind, votes), _ in counts.items():
        lean = sum(int(v) - 1 for v in votes)
        believed[kind, votes] = 1 / (1 + math.exp(-1.5 * lean))
    if not counts:
        return believed
    width = len(next(iter(counts))[1])
    for _ in range(EM_ROUNDS):
        chances: dict[tuple[int, str, int], float] = {}
        share: dict[str, list[float]] = {k: [1.0, 1.0] for k in KINDS}
        tally = {(i, v, truth): 1.0 for i in range(width) for v in "012" for truth in (0, 1)}
        for (kind, votes), n in counts.items():
            p = believed[kind, votes]
            share[kind][1] += n * p
            share[kind][0] += n * (1 - p)
            for i, v in enumerate(votes):
                tally[i, v, 1] += n * p
                tally[i, v, 0] += n * (1 - p)
        for i, truth in itertools.product(range(width), (0, 1)):
            total = sum(tally[i, v, truth] for v in "012")
            for v in "012":
                chances[i, v, truth] = tally[i, v, truth] / total
        for kind, votes in counts:
            odds = math.log(share[kind][1] / share[kind][0])
            odds += sum(math.log(chances[i, v, 1] / chances[i, v, 0]) for i, v in enumerate(votes))
            believed[kind, votes] = 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))
    return believed


def train_classifier(
    counts: dict[tuple[str, str, str], int], believed: dict[tuple[str, str], float], rounds: int = 300
) -> tuple[dict[tuple[int, str], float], float]:
    """Logistic regression on one-hot features with the posteriors as soft labels: weights and intercept."""
    weights: dict[tuple[int, str], float] = {}
    bias = 0.0
    total = sum(counts.values()) or 1
    for _ in range(rounds):
        step: dict[tuple[int, str], float] = {}
        bias_step = 0.0
        for (kind, votes, features), n in counts.items():
            z = bias + sum(weights.get(f, 0.0) for f in enumerate(features))
            error = (believed[kind, votes] - 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))) * n / total
            bias_step += error
            for f in enumerate(features):
                step[f] = step.get(f, 0.0) + error
        bias += bias_step
        for f, s in step.items():
            weights[f] = weights.get(f, 0.0) + 2.0 * s - 0.001 * weights.get(f, 0.0)
    return weights, bias


# How the features of a span begin: its kind, and whether it comes from a looser pattern.
_PATTERNS = tuple(f"{kind}{loose}" for loose in (0, 1) for kind in range(len(KINDS)))


def _pattern_of(span: Column) -> Column:
    return F.substring(span["features"], 1, 2)


def _taken(span: Column, lists: Column) -> Column:
    """Whether a looser span overlaps a base span, or a looser one of a pattern before its own.

    ``lists`` holds the base spans of each kind, then the looser ones of each pattern; a list's spans are in order and
    don't overlap, so a binary search finds the only one that can.
    """

    def overlaps(spans: Column) -> Column:
        steps = F.array(*[F.lit(1 << k) for k in reversed(range(30))])
        passed = F.aggregate(
            F.filter(steps, lambda by: by <= F.size(spans)),
            F.lit(0),
            lambda at, by: F.when(
                (at + by <= F.size(spans)) & (F.get(spans, at + by - 1)["end"] <= span["start"]), at + by
            ).otherwise(at),
        )
        return F.coalesce(F.get(spans, passed)["start"] < span["end"], F.lit(False))

    own = F.array_position(F.array(*map(F.lit, _PATTERNS)), _pattern_of(span)) - 1
    upto = F.slice(lists, 1, (own + len(KINDS)).cast("int"))
    return F.exists(upto, overlaps)


def find(docs: DataFrame) -> DataFrame:
    """doc_id (and a carried row) with ``found``: the spans of each text (k, start, end, kind, base).

    Spans are sorted by kind as listed in KINDS, then start. Looser spans that overlap a base span, or a looser
    candidate of a pattern before their own, are left out.
    """
    kept = stored(candidates(docs).drop("text"), "pii-candidates")
    combinations = (
        kept.select(F.explode("found").alias("s"))
        .groupBy("s.kind", "s.votes", "s.features")
        .count()
        .collect()  # one row per combination of votes and features
    )
    counts = {(r["kind"], r["votes"], r["features"]): r["count"] for r in combinations}
    votes: dict[tuple[str, str], int] = {}
    for (kind, vote, _), n in counts.items():
        votes[kind, vote] = votes.get((kind, vote), 0) + n
    weights, bias = train_classifier(counts, reliabilities(votes))
    accepted = sorted(
        {
            features
            for _, _, features in counts
            if 1 / (1 + math.exp(-(bias + sum(weights.get(f, 0.0) for f in enumerate(features))))) >= DECIDE_AT
        }
    )
    passes = lambda s: s["features"].isin(accepted) if accepted else F.lit(False)
    base = F.filter("found", lambda s: s["base"])
    loose = F.filter("found", lambda s: ~s["base"] & passes(s))
    added = let(
        F.array(
            *[F.filter(base, (lambda k: lambda s: s["kind"] == k)(k)) for k in KINDS],
            *[F.filter(loose, (lambda p: lambda s: _pattern_of(s) == p)(p)) for p in _PATTERNS],
        ),
        lambda lists: F.filter(loose, lambda s: ~_taken(s, lists)),
    )
    chosen = F.when(F.size(loose) > 0, F.concat(base, added)).otherwise(base)
    order = F.array_sort(
        F.transform(
            chosen,
            lambda s: F.struct(
                F.array_position(F.array(*map(F.lit, KINDS)), s["kind"]).alias("k"),
                s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"), s["base"].alias("base"),
            ),
        )
    )
    return kept.withColumn("found", order)


def spans_text(spans: Column) -> Column:
    """``kind:start:end`` of all spans, comma-joined."""
    return F.concat_ws(
        ",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    )


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every found span replaced by its kind in brackets; its other columns stay.

    Spans that overlap are replaced together, by the kind of the first.
    """
    found = find(packed(docs))
    text = F.col(ROW)["text"]
    by_start = F.array_sort(
        F.transform("found", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))
    )

    def rebuilt(spans: Column, ends: Column) -> Column:
        heads = F.filter(
            F.transform(spans, lambda s, i: F.when((i == 0) | (s["start"] >= F.get(ends, i - 1)), i)),
            lambda i: i.isNotNull(),
        )
        return let(heads, lambda h: let(in_blocks(text), lambda blocks: joined(spans, ends, h, blocks)))

    def joined(spans: Column, ends: Column, heads: Column, blocks: Column) -> Column:
        before = lambda i: F.when(i == 0, 0).otherwise(F.get(ends, i - 1))
        pieces = F.transform(
            heads,
            lambda i: F.concat(
                cut(blocks, before(i), F.get(spans, i)["start"]), F.lit("["), F.upper(F.get(spans, i)["kind"]), F.lit("]")
            ),
        )
        return F.concat(
            F.array_join(pieces, ""), cut(blocks, F.get(ends, F.size(ends) - 1), F.length(text))
        )

    changed = let(
        by_start,
        lambda spans: let(
            running(F.transform(spans, lambda s: s["end"]), lambda a, x: F.greatest(a, x)),
            lambda ends: rebuilt(spans, ends),
        ),
    )
    return found.select(*unpacked(docs, F.when(F.size("found") > 0, changed).otherwise(text)))
