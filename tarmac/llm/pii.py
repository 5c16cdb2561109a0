"""Personal data by weak supervision, with DataFrame functions only.

*Spans.* Patterns find candidate spans of four kinds. The base of a kind is its pattern with its
check (address parts, Luhn, number of digits); base spans are always reported. Matches that fail
the check, and matches of looser patterns, are candidates only.

*Votes.* Five labelers vote on each candidate: 1 for personal, -1 against, 0 without opinion.
They look at the strict pattern, the checksum or shape, a gazetteer (domains, country codes,
issuers, address ranges), helpful words before the span, and misleading surroundings.

*Reliabilities.* Expectation-maximisation estimates how often each labeler votes how, given
the truth, and the share of true spans of each kind. It runs over the table of vote patterns and
their counts, which has at most 4 x 3^5 rows whatever the data.

*Classifier.* A naive Bayes model over the span's own features is trained on the posteriors;
candidates it gives ``LEAST`` or more are reported too, unless they overlap a base span of their kind.

Places are code points, ends exclusive. The patterns are written so that Java's engine needs
neither recursion nor a second look at a run of characters: possessive loops, and a start either
after another character or where the last match ended. Null texts count as empty.

Rows may repeat: each votes again, and is reported alike. An empty table gives an empty table. Other columns pass
through ``find``; those named ``base``, ``other``, ``strict``, ``loose`` and ``added`` are replaced or go. Texts of any
length are whole; a text's spans are one row.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.llm.tables import settle

KINDS = ("email", "ip", "card", "phone")
_USER = r"A-Za-z0-9._%+-"
_HOST = r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
BASE = {
    "email": rf"(?:(?<![{_USER}])|\G)[{_USER}]++@{_HOST}",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
LOOSE = {
    "email": rf"(?<![{_USER}])[{_USER}]++ ?+[\[(]at[\])] ?+[A-Za-z0-9-]++(?:(?:\.| ?[\[(]dot[\])] ?)[A-Za-z0-9-]++)++",
    "phone": r"(?<![0-9+(.-])\(?[0-9]{3}\)?[ .-][0-9]{3}[.-][0-9]{4}(?![0-9])",
}
#: Mail providers and common endings, issuer prefixes, calling codes, words near spans.
DOMAINS = r"(?i)(?:gmail|yahoo|hotmail|outlook|icloud|proton|example)\.|\.(?:com|org|net|edu|gov|io|de|fr|es|uk)$"
ISSUERS = r"^(?:4|5[1-5]|2[2-7]|3[47]|6011|65|35|30|36|38)"
CODES = r"^\+(?:1|7|20|27|3[0-9]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])"
RANGES = r"^(?:10|127|172|192|169|8|1)\."
HELPFUL = {
    "email": r"(?i)(?:e-?mail|mail|contact|write|correo|courriel|kontakt)\W*\w*\W*$",
    "ip": r"(?i)(?:\bip\b|address|server|host|login|adresse|direcci)\W*\w*\W*$",
    "card": r"(?i)(?:card|visa|master|amex|credit|debit|karte|carte|tarjeta|account)\W*\w*\W*$",
    "phone": r"(?i)(?:phone|tel|call|mobile|cell|fax|whatsapp|anruf|appel)\W*\w*\W*$",
}
MISLEADING = r"(?i)(?:version|\bv|build|isbn|issn|order|invoice|serial|[#$€£=_/])\W?$"
LABELERS = ("strict", "shape", "gazetteer", "helpful", "surroundings")
ROUNDS = 12
LEAST = 0.5
BLOCK = 128
_SPAN = "array<struct<kind: int, start: int, stop: int, text: string, before: string, after: string>>"


def _prefix_sum(values: Column, i: Column) -> Column:
    """The sum of the first ``i`` values, from sums of blocks, so that long arrays stay cheap."""
    add = lambda part: F.aggregate(part, F.lit(0), lambda a, x: a + x)
    whole = (i / BLOCK).cast("int")
    blocks = F.transform(F.sequence(F.lit(0), (F.size(values) / BLOCK).cast("int")),
                         lambda b: add(F.slice(values, b * BLOCK + 1, F.lit(BLOCK))))
    return add(F.slice(blocks, F.lit(1), whole)) + add(F.slice(values, whole * BLOCK + 1, i - whole * BLOCK))


def _matches(text: Column, kind: int, pattern: str) -> Column:
    """All leftmost matches with their places, up to 40 characters before and 12 after each."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)  # one more than matches
    steps = F.zip_with(F.slice(gaps, F.lit(1), F.size(found)), found, lambda g, m: F.length(g) + F.length(m))

    def span(m: Column, i: Column) -> Column:
        gap = F.get(gaps, i)
        start = _prefix_sum(steps, i) + F.length(gap)
        return F.struct(
            F.lit(kind).alias("kind"), start.alias("start"), (start + F.length(m)).alias("stop"), m.alias("text"),
            F.right(gap, F.lit(40)).alias("before"), F.left(F.get(gaps, i + 1), F.lit(12)).alias("after"))

    return F.when(F.size(found) > 0, F.transform(found, span)).otherwise(F.array().cast(_SPAN)).cast(_SPAN)


def digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a string of digits has a valid check digit."""
    def add(total: Column, place: Column) -> Column:
        d = F.substring(number, -place, F.lit(1)).cast("int")
        doubled = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return total + F.when(place % 2 == 0, doubled).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), F.length(number)), F.lit(0), add) % 10 == 0


def _passes(kind: Column, text: Column) -> Column:
    """The check of a base pattern's match."""
    part = "0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
    number = digits(text)
    return (
        F.when(kind == 0, F.lit(True))
        .when(kind == 1, text.rlike(rf"^{part}(?:\.{part}){{3}}$"))
        .when(kind == 2, F.when(F.length(number).between(13, 19), luhn(number)).otherwise(F.lit(False)))
        .otherwise(F.length(number).between(9, 15))
    )


def candidates(docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` without the text, ``base`` spans, and ``other`` candidate spans."""
    text = F.coalesce(F.col("text"), F.lit(""))
    nothing = F.array().cast(_SPAN)
    worth = {"email": text.contains("@"), "phone": text.contains("+")}
    numbers = text.rlike("[0-9]")
    strict = F.concat(*[
        F.when(worth.get(name, numbers), _matches(text, k, BASE[name])).otherwise(nothing) for k, name in enumerate(KINDS)])
    loose = F.concat(
        F.when(text.rlike(r"[\[(]at[\])]"), _matches(text, 0, LOOSE["email"])).otherwise(nothing),
        F.when(numbers, _matches(text, 3, LOOSE["phone"])).otherwise(nothing))
    others = [c for c in docs.columns if c not in ("text", "base", "other", "strict", "loose")]
    found = settle(docs.select(*[F.col(f"`{c}`") for c in others], strict.alias("strict"), loose.alias("loose")), "spans")
    passes = lambda s: _passes(s["kind"], s["text"])
    base = F.filter("strict", passes)
    # A failed match is worth a vote if it is long enough to be what it looks like.
    near = F.filter("strict", lambda s: ~passes(s) & F.length(digits(s["text"])).between(
        F.when(s["kind"] == 2, 13).otherwise(8), 19))
    rows = found.select(*[F.col(f"`{c}`") for c in others], base.alias("base"), F.concat(near, "loose").alias("_other"))
    overlaps = lambda s: F.exists("base", lambda b: (b["kind"] == s["kind"]) & (b["start"] < s["stop"]) & (
        s["start"] < b["stop"]))
    return rows.withColumn("other", F.filter("_other", lambda s: ~overlaps(s))).drop("_other")


def _by_kind(kind: Column, *values: Column) -> Column:
    return reduce(lambda c, kv: c.when(kind == kv[0], kv[1]), enumerate(values[1:], 1), F.when(kind == 0, values[0]))


def votes(span: Column) -> list[Column]:
    """The votes of the labelers on a span, in their order."""
    kind, text, before, after = (span[c] for c in ("kind", "text", "before", "after"))
    number = digits(text)
    size = F.length(number)
    yes, no, none = F.lit(1), F.lit(-1), F.lit(0)
    strict = F.when(_passes(kind, text) & _by_kind(
        kind, text.contains("@"), F.lit(True), F.lit(True), text.startswith("+")), yes).otherwise(no)
    shape = F.when(_by_kind(
        kind, text.rlike(r"\.[A-Za-z]{2,6}$"), text.rlike(r"^[1-9][0-9]{0,2}(?:\.(?:0|[1-9][0-9]{0,2})){3}$"),
        text.rlike(r"^[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{1,7}$"), size.between(10, 13)), yes).otherwise(no)
    listed = F.when(_by_kind(
        kind, text.rlike(DOMAINS), text.rlike(RANGES), number.rlike(ISSUERS), text.rlike(CODES)), yes).otherwise(none)
    helpful = F.when(_by_kind(kind, *[before.rlike(HELPFUL[name]) for name in KINDS]), yes).otherwise(none)
    around = F.when(before.rlike(MISLEADING) | before.rlike(r"[\p{L}0-9]$") | after.rlike(r"^[\p{L}0-9_%]"), no).otherwise(none)
    return [strict, shape, listed, helpful, around]


def reliabilities(patterns: DataFrame) -> tuple[list[float], list[list[list[float]]]]:
    """Share of true spans per kind, and per labeler the shares of votes -1, 0, 1 on false and on true spans.

    ``patterns`` has ``kind``, a column per labeler, and ``n``. Counts are smoothed by one; figures
    are rounded, so that the order of additions does not show.
    """
    ballot = reduce(lambda a, b: a + b, [F.col(c) for c in LABELERS])
    posterior: Column = F.when(ballot > 0, 0.9).when(ballot < 0, 0.1).otherwise(0.5)
    prior, tables = [0.5] * len(KINDS), []
    for _ in range(ROUNDS):
        weight = {True: F.col("n") * posterior, False: F.col("n") * (1 - posterior)}
        sums = [F.sum(F.when(F.col("kind") == k, weight[truth])) for k in range(len(KINDS)) for truth in (False, True)]
        sums += [F.sum(F.when(F.col(c) == v, weight[truth])) for c in LABELERS for truth in (False, True) for v in (-1, 0, 1)]
        got = [round(x or 0.0, 6) + 1.0 for x in patterns.agg(*[s.alias(f"s{i}") for i, s in enumerate(sums)]).first()]
        prior = [got[2 * k + 1] / (got[2 * k] + got[2 * k + 1]) for k in range(len(KINDS))]
        cells = got[2 * len(KINDS):]
        tables = [[[x / sum(row) for x in row] for row in (cells[i:i + 3], cells[i + 3:i + 6])]
                  for i in range(0, len(cells), 6)]
        posterior = _posterior(prior, tables)
    return prior, tables


def _posterior(prior: list[float], tables: list[list[list[float]]]) -> Column:
    def pick(values: list[float], at: Column) -> Column:
        return F.element_at(F.array(*[F.lit(round(v, 9)) for v in values]), at.cast("int"))

    odds = pick([math.log(p / (1 - p)) for p in prior], F.col("kind") + 1)
    for column, (false, true) in zip(LABELERS, tables):
        odds = odds + pick([math.log(t / f) for f, t in zip(false, true)], F.col(column) + 2)
    return 1 / (1 + F.exp(-odds))


def features(span: Column) -> dict[str, Column]:
    """What the final classifier sees of a span; every feature has few values."""
    kind, text, before, after = (span[c] for c in ("kind", "text", "before", "after"))
    side = lambda c: F.when(c == "", "edge").when(c.rlike(r"\s"), "blank").when(c.rlike(r"[\p{L}0-9]"), "word").otherwise("sign")
    tagged = lambda c: F.concat(kind.cast("string"), F.lit(":"), c)
    strict, shape, listed, helpful, around = votes(span)
    return {
        "digits": tagged(F.least(F.length(digits(text)), F.lit(20)).cast("string")),
        "groups": tagged(F.least(F.size(F.split(text, r"[^0-9A-Za-z]+")), F.lit(6)).cast("string")),
        "left": tagged(side(F.right(before, F.lit(1)))),
        "right": tagged(side(F.left(after, F.lit(1)))),
        "form": tagged(F.concat_ws("", strict.cast("string"), shape.cast("string"), listed.cast("string"))),
        "context": tagged(F.concat_ws("", helpful.cast("string"), around.cast("string"))),
    }


def train(found: DataFrame) -> dict[str, float]:
    """Weight of every feature value, and the weight of each kind itself, from EM's posteriors."""
    spans = found.select(F.explode(F.concat("base", "other")).alias("s"))
    seen = spans.select(
        F.col("s.kind").alias("kind"), *[v.alias(c) for c, v in zip(LABELERS, votes(F.col("s")))],
        *[v.alias(f"f_{c}") for c, v in features(F.col("s")).items()])
    kinds_of_spans = settle(seen.groupBy(*seen.columns).agg(F.count("*").alias("n")), "span-kinds")
    patterns = settle(kinds_of_spans.groupBy("kind", *LABELERS).agg(F.sum("n").alias("n")), "vote-patterns")
    prior, tables = reliabilities(patterns)
    if not tables:
        return {}
    names = [c for c in kinds_of_spans.columns if c.startswith("f_")]
    told = kinds_of_spans.withColumn("p", _posterior(prior, tables)).select(
        "kind", "n", "p", F.explode(F.array(F.lit("kind"), *[F.concat(F.lit(c + "="), c) for c in names])).alias("value"))
    sums = told.groupBy("kind", "value").agg(
        F.sum(F.col("n") * F.col("p")).alias("yes"), F.sum(F.col("n") * (1 - F.col("p"))).alias("no")).collect()
    totals = {r["kind"]: (r["yes"] + 1, r["no"] + 1) for r in sums if r["value"] == "kind"}
    weights = {f"kind={k}": math.log(yes / no) for k, (yes, no) in totals.items()}
    for r in sums:
        if r["value"] != "kind":
            yes, no = totals[r["kind"]]
            weights[r["value"]] = math.log((r["yes"] + 0.5) / (yes + 1) / ((r["no"] + 0.5) / (no + 1)))
    return {k: round(v, 6) for k, v in weights.items()}


def probability(span: Column, weights: dict[str, float]) -> Column:
    table = F.create_map(*[F.lit(x) for kv in sorted(weights.items()) for x in kv])
    weight = lambda key: F.coalesce(F.try_element_at(table, key), F.lit(0.0))
    odds = weight(F.concat(F.lit("kind="), span["kind"].cast("string")))
    for name, value in features(span).items():
        odds = odds + weight(F.concat(F.lit(f"f_{name}="), value))
    return 1 / (1 + F.exp(-odds))


def find(docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` without the text, ``base`` spans and ``added`` spans."""
    found = settle(candidates(docs), "candidates")
    weights = train(found)
    if not weights:
        return found.withColumnRenamed("other", "added")
    kept = F.filter("other", lambda s: probability(s, weights) >= LEAST)
    return found.withColumn("added", kept).drop("other")


def report(docs: DataFrame, *keys: str) -> DataFrame:
    """Per row its ``keys``, base counts, a digest of the base spans, and all spans as kind:start:end."""
    names = F.array(*map(F.lit, KINDS))
    shown = lambda spans: F.array_join(F.transform(F.array_sort(F.transform(
        spans, lambda s: F.struct(s["kind"], s["start"], s["stop"]))), lambda s: F.concat_ws(
            ":", F.get(names, s["kind"]), s["start"].cast("string"), s["stop"].cast("string"))), ",")
    def of_kind(k: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")

    return find(docs.select(*keys, "text")).select(
        *keys, *[of_kind(k).alias(f"n_{name}") for k, name in enumerate(KINDS)],
        F.sha2(shown(F.col("base")), 256).alias("base_sha256"),
        shown(F.concat("base", "added")).alias("spans"),
    )
