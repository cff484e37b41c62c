"""Personal data by weak supervision.

Patterns propose spans. Three labelers vote on each: its form, a gazetteer of known parts, and the words before it.
Expectation-maximisation over the counts of vote patterns estimates how far each labeler can be trusted, its posteriors
train a logistic span classifier, and the classifier decides on spans that no fixed rule settles.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourloom.llm.common import each, landed, only

# The patterns of the base kinds. Possessive forms and the look-behind match what the plain forms match,
# in linear time and without deep recursion.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
OCTETS = r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])\.){3}0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])$"


def digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def luhn(c: Column) -> Column:
    """Whether the digits of `c` pass the checksum of card numbers."""
    back = F.reverse(digits(c))

    def value(i: Column) -> Column:
        d = F.substring(back, i, F.lit(1)).cast("int")
        twice = d * 2
        return F.when(i % 2 == 1, d).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

    spots = F.sequence(F.lit(1), F.greatest(F.length(back), F.lit(1)))
    return (F.length(back) > 0) & (F.aggregate(F.transform(spots, value), F.lit(0), lambda a, v: a + v) % 10 == 0)


@dataclass(frozen=True)
class Kind:
    """How one kind of span is proposed and judged. `valid` is the form labeler; `base` spans that are valid always stay."""

    name: str
    pattern: str
    needs: str  # a text without this can't match
    valid: object
    known: str  # the gazetteer, as a pattern over the span
    cue: str  # words before it that speak for it
    base: bool = False


# Patterns, gazetteers and cue words.
KINDS = (
    Kind("email", EMAIL, "@", lambda t: F.lit(True), r"(?i)\.(com|org|net|edu|gov|info|io|de|fr|es|uk|eu)$", r"(?i)(mail|contact|write|reply|reach)", True),
    Kind("ip", IP, r"[0-9]\.[0-9]", lambda t: t.rlike(OCTETS), r"^(10|127|172|192|[1-9][0-9]?)\.", r"(?i)(ip|host|server|address|addr|from)\b", True),
    Kind("card", CARD, "[0-9]", lambda t: F.length(digits(t)).between(13, 19) & luhn(t), r"^(3[47]|4|5[1-5]|2[2-7]|6011|65)", r"(?i)(card|visa|credit|pay|account)", True),
    Kind("phone", PHONE, r"\+[0-9]", lambda t: F.length(digits(t)).between(9, 15), r"^\+(1|7|33|34|44|49|39|41|43|55|81|86|91)", r"(?i)(phone|tel|call|mobile|fax)", True),
    Kind(
        "secret",
        r"(?i)\b(?:pass(?:word|wd)|secret|token|api[_-]?key)\b\x20?[:=]\x20?[\"']?[A-Za-z0-9/+_-]{8,}+|\bAKIA[0-9A-Z]{16}\b",
        r"[=:]|AKIA",
        lambda t: t.rlike(r"[0-9].*[0-9]"),
        r"(?i)(password|token|secret|api|AKIA)",
        r"(?i)(login|user|auth|credential|config)",
    ),
    Kind(
        "iban",
        r"\b[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){3,7}+(?:\x20?[A-Z0-9]{1,3})?\b",
        r"[A-Z]{2}[0-9]{2}",
        lambda t: F.length(digits(t)) >= 10,
        r"^(DE|FR|ES|GB|IT|NL|BE|AT|CH|PL|PT)",
        r"(?i)(iban|account|bank|konto)",
    ),
    Kind("national_id", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", r"-[0-9]{2}-", lambda t: ~t.rlike("^(000|666|9)"), r"^[0-8]", r"(?i)(ssn|social|security|id)\b"),
)
CONTEXT = 24  # characters before a span that the context labeler reads
FEATURES = ("form", "known", "cue")


BLOCK = 128  # spans that one pass gathers; arrays that grow by one at a time are copied each time
SPAN = "array<struct<start:int,end:int,form:int,known:int,cue:int>>"


def _blocks(size: Column) -> Column:
    """Numbers of the blocks that `size` elements fill; none for no element."""
    return F.when(size > 0, F.sequence(F.lit(0), F.floor((size - 1) / BLOCK).cast("int"))).otherwise(F.array().cast("array<int>"))


def _spans(kind: Kind, found: str, parts: str) -> Column:
    """For each block of what the pattern finds: its length in code points (`at`) and structs of start, end and votes, counted
    from the start of the block, from the pieces between the finds."""
    part, match = (lambda i: F.get(F.col(parts), i)), (lambda i: F.get(F.col(found), i))

    def step(a: Column, i: Column) -> Column:
        start = a["at"] + F.length(part(i))
        end = start + F.length(match(i))
        span = F.struct(
            start.alias("start"),
            end.alias("end"),
            F.when(kind.valid(match(i)), 1).otherwise(-1).alias("form"),
            F.when(match(i).rlike(kind.known), 1).otherwise(-1).alias("known"),
            F.when(F.right(part(i), F.lit(CONTEXT)).rlike(kind.cue), 1).otherwise(0).alias("cue"),
        )
        return F.struct(end.alias("at"), F.concat(a["spans"], F.array(span)).alias("spans"))

    def block(k: Column) -> Column:
        own = F.sequence(k * BLOCK, F.least(k * BLOCK + BLOCK, F.size(found)) - 1)
        return F.aggregate(own, F.struct(F.lit(0).alias("at"), F.array().cast(SPAN).alias("spans")), step)

    return F.transform(_blocks(F.size(found)), block)


def _moved(blocks: str) -> Column:
    """The spans of all blocks, counted from the start of the text."""

    def add(a: Column, b: Column) -> Column:
        return F.struct((a["at"] + b["at"]).alias("at"), F.concat(a["before"], F.array(a["at"])).alias("before"))

    before = F.aggregate(blocks, F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("before")), add, lambda a: a["before"])

    def shifted(b: Column, by: Column) -> Column:
        def one(s: Column, by: Column) -> Column:
            return F.struct((s["start"] + by).alias("start"), (s["end"] + by).alias("end"), s["form"].alias("form"), s["known"].alias("known"), s["cue"].alias("cue"))

        return each(b["spans"], one, by)

    return F.flatten(F.zip_with(blocks, before, shifted))


def candidates(docs: DataFrame, keep: tuple[str, ...], text_col: str = "text", kinds: tuple[Kind, ...] = KINDS) -> DataFrame:
    """`doc`, a struct of the columns `keep`, and one array of proposed spans for each kind (`s_<kind>`)."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    step = docs.select(F.struct(*[F.col(f"`{c}`").alias(c) for c in keep]).alias("doc"), text.alias("txt"))
    none = F.array().cast("array<string>")
    step = step.select("*", *[F.when(F.col("txt").rlike(k.needs), F.regexp_extract_all("txt", F.lit(k.pattern), F.lit(0))).otherwise(none).alias(f"m_{k.name}") for k in kinds])
    step = step.select("*", *[F.when(F.size(f"m_{k.name}") > 0, F.split("txt", k.pattern, -1)).otherwise(none).alias(f"p_{k.name}") for k in kinds])
    step = step.select("doc", *[_spans(k, f"m_{k.name}", f"p_{k.name}").alias(f"b_{k.name}") for k in kinds])
    return step.select("doc", *[_moved(f"b_{k.name}").alias(f"s_{k.name}") for k in kinds])


def reliabilities(counts: dict[tuple, int], rounds: int = 50) -> tuple[dict, dict, dict]:
    """EM over counts of (kind, form, known, cue).

    Gives the probability of each pattern, for each labeler the chance that its vote is right, for each kind its prior.
    Labelers are taken as independent given the truth; a vote of 0 abstains. Smoothing keeps every chance within (0.5, 1).
    """
    right = [0.9, 0.7, 0.7]
    prior = {p[0]: 0.5 for p in counts}
    post: dict[tuple, float] = {}
    for _ in range(rounds):
        for p in counts:
            odds = math.log(prior[p[0]] / (1 - prior[p[0]]))
            odds += sum(v * math.log(r / (1 - r)) for v, r in zip(p[1:], right, strict=True))
            post[p] = 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))
        for kind in prior:
            n = sum(c for p, c in counts.items() if p[0] == kind)
            prior[kind] = min(0.99, max(0.01, (1 + sum(c * post[p] for p, c in counts.items() if p[0] == kind)) / (2 + n)))
        for j in range(3):
            good = sum(c * (post[p] if p[j + 1] > 0 else 1 - post[p]) for p, c in counts.items() if p[j + 1])
            right[j] = min(0.99, max(0.51, (7 + good) / (10 + sum(c for p, c in counts.items() if p[j + 1]))))
    return post, dict(zip(FEATURES, right, strict=True)), prior


def span_classifier(counts: dict[tuple, int], post: dict[tuple, float], rounds: int = 400, rate: float = 0.5, ridge: float = 1e-3) -> tuple[dict, list[float]]:
    """Logistic regression on the votes with a bias for each kind, fitted to the posteriors of the vote patterns."""
    bias = {p[0]: 0.0 for p in counts}
    weight = [0.0, 0.0, 0.0]
    total = sum(counts.values()) or 1
    by_kind = {k: sum(c for p, c in counts.items() if p[0] == k) or 1 for k in bias}
    for _ in range(rounds):
        grad, grads = [0.0] * 3, dict.fromkeys(bias, 0.0)
        for p, c in counts.items():
            z = bias[p[0]] + sum(w * v for w, v in zip(weight, p[1:], strict=True))
            miss = c * (1 / (1 + math.exp(-z)) - post[p])
            grads[p[0]] += miss
            for j in range(3):
                grad[j] += miss * p[j + 1]
        weight = [w - rate * (g / total + ridge * w) for w, g in zip(weight, grad, strict=True)]
        bias = {k: b - rate * (grads[k] / by_kind[k] + ridge * b) for k, b in bias.items()}
    return bias, weight


def detect(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), text_col: str = "text", kinds: tuple[Kind, ...] = KINDS, threshold: float = 0.5) -> DataFrame:
    """One row for each row of `docs`: the columns `keep` and `spans`, an array of kind, rank (the kind's place in
    `kinds`), start, end (code points, end exclusive), base and score, ordered by kind and start.

    Valid spans of base kinds always stay, with whatever score; others stay if the classifier gives `threshold`. A null
    text is empty and has no span. Equal rows each get a row; columns besides are ignored; an empty table gives an empty
    one. Nothing is shuffled but the counts of vote patterns, at most 18 for each kind.
    """
    return _judged(docs, keep, text_col, kinds, threshold).select("doc.*", "spans")


def _judged(docs: DataFrame, keep: tuple[str, ...], text_col: str, kinds: tuple[Kind, ...] = KINDS, threshold: float = 0.5) -> DataFrame:
    """`doc`, a struct of the columns `keep`, and `spans`."""
    found = landed(candidates(docs, keep, text_col, kinds), "pii-candidates")

    def votes(s: Column, kind: str) -> Column:
        return F.struct(F.lit(kind).alias("kind"), s["form"].alias("form"), s["known"].alias("known"), s["cue"].alias("cue"))

    every = F.concat(*[each(f"s_{k.name}", votes, k.name) for k in kinds])
    rows = found.select(F.explode(every).alias("v")).groupBy("v.kind", "v.form", "v.known", "v.cue").count().collect()
    counts = {(r["kind"], r["form"], r["known"], r["cue"]): r["count"] for r in rows}
    post, _, _ = reliabilities(counts)
    bias, weight = span_classifier(counts, post)

    def judged(rank: int, k: Kind) -> Column:
        def span(s: Column) -> Column:
            z = sum((F.lit(w) * s[f] for w, f in zip(weight, FEATURES, strict=True)), F.lit(bias.get(k.name, 0.0)))
            return F.struct(
                F.lit(rank).alias("rank"), s["start"].alias("start"), s["end"].alias("end"), F.lit(k.name).alias("kind"),
                (F.lit(k.base) & (s["form"] > 0)).alias("base"), (1 / (1 + F.exp(-z))).alias("score"),
            )

        return F.filter(F.transform(f"s_{k.name}", span), lambda s: s["base"] | (F.lit(not k.base) & (s["score"] >= threshold)))

    return found.select("doc", F.sort_array(F.concat(*[judged(i, k) for i, k in enumerate(kinds)])).alias("spans"))


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`docs` with every span in its text replaced by its kind in angle brackets; overlapping spans become one, named
    after the first. Null and clean texts stay as they are, other columns too, whatever their names; the order of columns
    is kept. The work on a text grows with its length and its spans.
    """
    found = _judged(docs, tuple(docs.columns), text_col)
    by_start = F.sort_array(F.transform("spans", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    rows = found.select("doc", by_start.alias("by_start"))
    rows = rows.withColumn("blocks", F.transform(_blocks(F.size("by_start")), lambda k: F.slice("by_start", k * BLOCK + 1, F.lit(BLOCK))))

    def reach(a: Column, b: Column) -> Column:
        return F.struct(F.greatest(a["at"], F.array_max(F.transform(b, lambda s: s["end"]))).alias("at"), F.concat(a["before"], F.array(a["at"])).alias("before"))

    # how far the spans of earlier blocks reach
    before = F.aggregate("blocks", F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("before")), reach)
    pieces = F.array().cast("array<struct<low:int,high:int,kind:string>>")

    def step(a: Column, s: Column) -> Column:
        piece = F.struct(a["at"].alias("low"), s["start"].alias("high"), s["kind"].alias("kind"))
        more = F.when(s["start"] >= a["at"], F.concat(a["out"], F.array(piece))).otherwise(a["out"])
        return F.struct(F.greatest(a["at"], s["end"]).alias("at"), more.alias("out"))

    def cut(b: Column, at: Column) -> Column:
        return F.aggregate(b, F.struct(at.alias("at"), pieces.alias("out")), step, lambda a: a["out"])

    rows = rows.withColumn("reach", before)
    rows = rows.select("doc", F.flatten(F.zip_with("blocks", "reach.before", cut)).alias("pieces"), F.col("reach.at").alias("last"))
    text = F.col("doc").getField(text_col)
    hit = text.isNotNull() & (F.size("pieces") > 0)
    rows = rows.withColumn("chars", F.when(hit, F.split(text, "")))

    def told(p: Column) -> Column:
        return F.concat(F.array_join(F.slice("chars", p["low"] + 1, p["high"] - p["low"]), ""), F.lit("<"), F.upper(p["kind"]), F.lit(">"))

    tail = F.array_join(F.slice("chars", F.col("last") + 1, F.greatest(F.size("chars") - F.col("last"), F.lit(0))), "")
    clean = F.concat(F.array_join(F.transform("pieces", told), ""), tail)
    rows = rows.select("doc", F.when(hit, clean).otherwise(text).alias("clean"))
    return rows.select(*[F.col("clean").alias(c) if c == text_col else F.col("doc").getField(c).alias(c) for c in docs.columns])


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts of the base kinds, the hash of the base spans and all spans as text."""

    def named(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    base = F.filter("spans", lambda s: s["base"])
    counts = [F.size(only("spans", lambda s, kind: s["base"] & (s["kind"] == kind), k)).cast("long").alias(f"n_{k}") for k in ("email", "ip", "card", "phone")]
    return found.select(id_col, *counts, F.sha2(named(base), 256).alias("base_sha256"), named(F.col("spans")).alias("spans"))
