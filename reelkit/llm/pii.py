"""Operator 12, personal data: overlapping candidate spans, boosted trees and calibrated thresholds, in DataFrame
operations only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelkit.llm.common import stored, text_or_empty
from reelkit.operators import boosting

KINDS = ("email", "ip", "card", "phone")
#: Characters on either side of a span that its features look at.
CONTEXT = 24
#: One document in so many calibrates the thresholds, above which this share of so many labelled spans must be right.
FOLDS, PRECISION, LEAST = 3, 0.95, 5
ROUNDS, DEPTH, RATE = 8, 3, 0.5

_LOCAL, _LABEL = r"A-Za-z0-9._%+-", r"[A-Za-z0-9-]++"
_DOMAIN = rf"{_LABEL}(?:\.{_LABEL})++"
#: The base patterns, written so that none is tried anew inside a run that has failed: same matches, linear time.  A
#: run of local characters starts after another character or where the match before has ended.
BASE = (
    rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@{_DOMAIN}",
    r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    r"(?<![0-9])[0-9](?:[\x20-]?+[0-9])++",
    r"\+[0-9][\x20().0-9-]+[0-9]",
)
_WIDE = r"\p{L}\p{M}\p{N}._%+'-"
_AT, _DOT = r"\x20?[\[({<]\x20?(?:at|AT|@)\x20?[\])}>]\x20?", r"(?:\x20?[\[({<]\x20?(?:dot|DOT|\.)\x20?[\])}>]\x20?|\.)"
#: (kind, pattern) of what else may be personal data.  They overlap each other and the base spans, and each is bounded
#: in what a position may cost.
GENERATORS = (
    (0, rf"(?:\G|(?<![{_WIDE}]))[{_WIDE}]++@{_DOMAIN}"),
    (0, rf"(?<![{_LOCAL}])[{_LOCAL}]{{1,64}}+{_AT}[A-Za-z0-9-]{{1,63}}+(?:{_DOT}[A-Za-z0-9-]{{1,63}}+){{1,4}}"),
    (1, r"(?<![0-9.])[0-9]{1,3}(?:(?:\x20?\[\.\]\x20?|\x20?\(\.\)\x20?|\.)[0-9]{1,3}){3}(?![0-9])"),
    (2, r"(?<![0-9])[0-9]{13,19}(?![0-9])"),
    (2, r"(?<![0-9])[0-9]{4}(?:[\x20./-][0-9]{4}){3}(?![0-9])"),
    (2, r"(?<![0-9])[0-9]{4}[\x20./-][0-9]{6}[\x20./-][0-9]{5}(?![0-9])"),
    (3, r"(?<![0-9+.])(?:\+|00)?\(?[0-9]{1,4}\)?(?:[\x20./-]\(?[0-9]{2,4}\)?){2,5}(?![0-9])"),
)
#: Words near personal data, and near numbers that are none.
CUES = (r"(?i)mail|contact|kontakt|courriel|correo", r"(?i)\b(?:tel|phone|fax|call|mobile|handy|anruf|appel)",
        r"(?i)card|visa|carte|karte|tarjeta|konto|account", r"(?i)\bip\b|host|server|addr",
        r"(?i)token|key|secret|hash|isbn|version")

_SPAN = "array<struct<start:int,end:int,text:string,left:string,right:string>>"


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is made once, however often the body asks for it."""
    return F.get(F.transform(F.array(value), body), 0)


def sums_before(sizes: Column) -> Column:
    """For each element of an array of ints the sum of those before it, by blocks of the root of the length: work
    grows with the length to the power 1.5 and not with its square."""
    zero = F.lit(0)

    def blocks(s: Column) -> Column:
        block = F.ceil(F.sqrt(F.size(s))).cast("int")
        each = F.transform(F.sequence(zero, F.floor((F.size(s) - 1) / block).cast("int")), lambda b: F.slice(s, b * block + 1, block))
        running = lambda xs, start: F.aggregate(
            xs, F.struct(start.alias("at"), F.array().cast("array<int>").alias("out")),
            lambda a, x: F.struct((a["at"] + x).alias("at"), F.concat(a["out"], F.array(a["at"])).alias("out")), lambda a: a["out"])
        total = lambda xs: F.aggregate(xs, zero, lambda a, x: a + x)
        return bound(each, lambda e: bound(running(F.transform(e, total), zero), lambda firsts: F.flatten(
            F.zip_with(e, firsts, lambda xs, at: running(xs, at)))))

    return F.when(F.size(sizes) > 0, bound(sizes, blocks)).otherwise(F.array().cast("array<int>"))


def occurrences(text: Column, pattern: str) -> Column:
    """All leftmost non-overlapping matches of a pattern: start and end in code points, the text, and what is beside it.

    Splitting by the pattern gives what lies between its matches, and lengths
    add up to places; a text without a match is only searched.
    """
    def spans(found: Column, gaps: Column) -> Column:
        sizes = F.zip_with(F.slice(gaps, 1, F.size(found)), found, lambda g, m: F.char_length(g) + F.char_length(m))
        return bound(sums_before(sizes), lambda before: F.transform(found, lambda m, i: F.struct(
            (F.get(before, i) + F.char_length(F.get(gaps, i))).alias("start"),
            (F.get(before, i) + F.char_length(F.get(gaps, i)) + F.char_length(m)).alias("end"), m.alias("text"),
            F.right(F.concat(F.coalesce(F.get(found, i - 1), F.lit("")), F.get(gaps, i)), F.lit(CONTEXT)).alias("left"),
            F.left(F.concat(F.get(gaps, i + 1), F.coalesce(F.get(found, i + 1), F.lit(""))), F.lit(CONTEXT)).alias("right"))))

    both = F.struct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found"), F.split(text, pattern, -1).alias("gaps"))
    return F.when(text.rlike(pattern), bound(both, lambda b: spans(b["found"], b["gaps"]))).otherwise(F.array()).cast(_SPAN)


def digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    def value(d: Column, i: Column) -> Column:
        twice = d * (1 + i % 2)
        return F.when(twice > 9, twice - 9).otherwise(twice)
    n = F.char_length(number)
    each = F.transform(F.sequence(F.lit(0), n - 1), lambda i: value(F.substring(number, n - i, F.lit(1)).cast("int"), i))
    return F.aggregate(each, F.lit(0), lambda a, x: a + x) % 10 == 0


def passes(kind: int, text: Column, wide: bool = False) -> Column:
    """The base rule's check of a match.  Wide ones may be shorter cards, and an address in any writing has no check."""
    number = digits(text)
    if kind == 1:
        return F.forall(F.regexp_extract_all(text, F.lit("[0-9]+"), F.lit(0)),
                        lambda p: p.rlike(r"^0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})$"))
    if kind == 2:
        return F.when(F.char_length(number).between(13 if wide else 16, 19), luhn(number)).otherwise(F.lit(False))
    if kind == 3:
        return F.char_length(number).between(8, 15)
    return F.lit(True)


def _side(c: Column) -> Column:
    """What stands beside a span: nothing, a letter, a digit, white space, a quote or equals sign, or something else."""
    return (F.when(c == "", 0.0).when(c.rlike(r"^\p{L}"), 1.0).when(c.rlike("^[0-9]"), 2.0).when(c.rlike(r"^\s"), 3.0)
             .when(c.rlike("^[\"'=]"), 4.0).otherwise(5.0))


def features(kind: int, span: Column) -> Column:
    """Format and context of a candidate, as an array of numbers."""
    t, left, right = span["text"], span["left"], span["right"]
    count = lambda s, p: F.regexp_count(s, F.lit(p)).cast("double")
    number = digits(t)
    groups = F.transform(F.regexp_extract_all(t, F.lit("[0-9]+"), F.lit(0)), lambda g: F.char_length(g))
    octets = F.transform(F.regexp_extract_all(t, F.lit("[0-9]+"), F.lit(0)), lambda g: F.substring(F.concat(F.lit("0"), g), -4, 4).cast("int"))
    real = lambda c: F.coalesce(c.cast("double"), F.lit(-1.0))
    return F.array(
        F.lit(float(kind)), F.char_length(t).cast("double"), F.char_length(number).cast("double"), count(t, r"\p{L}"),
        F.size(groups).cast("double"), real(F.array_max(groups)), real(F.array_min(groups)), real(F.array_max(octets)),
        F.when(F.char_length(number).between(12, 19), luhn(number).cast("double")).otherwise(-1.0),
        F.startswith(t, F.lit("+")).cast("double"), count(t, "[()]"), count(t, " "), count(t, "-"), count(t, r"\."), count(t, "@"),
        F.char_length(F.regexp_extract(F.right(t, F.lit(CONTEXT)), "([A-Za-z]*)$", 1)).cast("double"),
        _side(F.right(left, F.lit(1))), _side(right), count(left, "[0-9]"), count(right, "[0-9]"),
        *[F.concat_ws(" ", left, right).rlike(c).cast("double") for c in CUES])


def first_ending_after(spans: Column, at: Column) -> Column:
    """Index of the first of sorted spans that do not overlap whose end lies after a place, by halving."""
    def half(s: Column) -> Column:
        mid = F.floor((s["lo"] + s["hi"]) / 2).cast("int")
        after = F.coalesce(F.get(spans, mid)["end"] > at, F.lit(True))
        return F.struct(F.when(after, s["lo"]).otherwise(mid + 1).alias("lo"), F.when(after, mid).otherwise(s["hi"]).alias("hi"))
    whole = F.struct(F.lit(0).alias("lo"), F.size(spans).alias("hi"))
    steps = F.sequence(F.lit(1), F.char_length(F.bin(F.size(spans))))
    return F.aggregate(steps, whole, lambda s, _: F.when(s["lo"] < s["hi"], half(s)).otherwise(s), lambda s: s["lo"])


def _over(spans: Column, span: Column) -> Column:
    """The one of sorted spans that do not overlap which a span lies over first, or null."""
    return bound(first_ending_after(spans, span["start"]),
                 lambda i: F.when(F.get(spans, i)["start"] < span["end"], F.get(spans, i)))


_PROPOSAL = "array<struct<kind:int,start:int,end:int,label:int,open:boolean,features:array<double>>>"


def _proposal(kind: int, span: Column, label: Column, open_: Column) -> Column:
    return F.struct(F.lit(kind).alias("kind"), span["start"].alias("start"), span["end"].alias("end"),
                    label.cast("int").alias("label"), open_.alias("open"), features(kind, span).alias("features"))


def _matched(kind: int) -> Column:
    """A base pattern's own matches, by whether they pass."""
    return F.transform(f"m{kind}", lambda s: _proposal(kind, s, passes(kind, s["text"]), F.lit(False))).cast(_PROPOSAL)


def _generated(kind: int, column: str) -> Column:
    """A generator's spans, but for those that are base spans themselves."""
    def propose(s: Column) -> Column:
        def by(own: Column) -> Column:
            other = F.coalesce(*[_over(F.col(f"b{k}"), s) for k in range(len(KINDS)) if k != kind]).isNotNull()
            label = F.when(other, 0).when(own.isNotNull(), F.lit(None)).when(~passes(kind, s["text"], wide=True), 0)
            same = F.coalesce((own["start"] == s["start"]) & (own["end"] == s["end"]), F.lit(False))
            return F.when(~same, _proposal(kind, s, label, ~other))
        return bound(_over(F.col(f"b{kind}"), s), by)
    return F.filter(F.transform(column, propose), lambda c: c.isNotNull()).cast(_PROPOSAL)


def _passing(kind: int) -> Column:
    return F.filter(f"m{kind}", lambda s: passes(kind, s["text"]))


def _places(kind: int) -> Column:
    return F.transform(f"b{kind}", lambda s: F.struct(F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end")))


def candidates(docs: DataFrame) -> DataFrame:
    """doc_id, base (kind, start, end of the base spans, by kind and start) and proposals of every row.

    Proposals are the matches of the base patterns and what the generators
    add.  Label 1: a base span.  Label 0: a span that its kind's check
    refuses, or one that lies over another kind's base span.  No label: what
    the base rule says nothing about.  Those that are ``open`` may be added.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    text, kinds = F.col("text"), range(len(KINDS))
    matched = rows.select("doc_id", *[occurrences(text, p).alias(f"m{k}") for k, p in enumerate(BASE)],
                          *[occurrences(text, p).alias(f"g{i}") for i, (_, p) in enumerate(GENERATORS)])
    base = matched.withColumns({f"b{k}": _passing(k) for k in kinds})
    return base.select("doc_id", F.concat(*[_places(k) for k in kinds]).alias("base"),
                       F.concat(*[_matched(k) for k in kinds], *[_generated(k, f"g{i}") for i, (k, _) in enumerate(GENERATORS)]).alias("proposals"))


def _score(model: boosting.Booster, features_: Column) -> Column:
    return model.probabilities(features_)[1]


def fit(found: DataFrame) -> tuple[boosting.Booster, list[float]]:
    """Boosted trees on the labelled proposals of all documents but one fold, and for each kind the least score from
    which that fold's labelled proposals are right often enough (above 1: none is).

    Both are aggregates: what reaches the driver is a row a node, or a kind and
    hundredth of the score.
    """
    c = F.col("c")
    labelled = (found.select("doc_id", F.explode("proposals").alias("c")).filter(c["label"].isNotNull())
                .select(F.concat_ws(":", "doc_id", c["kind"], c["start"], c["end"]).alias("id"), c["label"].cast("string").alias("label"),
                        c["features"].alias("features"), c["kind"].alias("kind"),
                        (F.coalesce(F.crc32(F.col("doc_id").cast("string")), F.lit(1)) % FOLDS == 0).alias("held")))
    labelled = stored(labelled, "labelled")
    model = boosting.fit(labelled.filter(~F.col("held")), ROUNDS, DEPTH, RATE)
    never = [2.0] * len(KINDS)
    if len(model.classes) < 2:
        return model, never
    at = F.floor(_score(model, F.col("features")) * 100).cast("int")
    bins = (labelled.filter("held").select("kind", at.alias("at"), F.col("label").cast("int").alias("label"))
            .groupBy("kind", "at").agg(F.sum("label").alias("right"), F.count(F.lit(1)).alias("n")).collect())
    for kind in range(len(KINDS)):
        right = n = 0
        for r in sorted((r for r in bins if r["kind"] == kind and r["at"] >= 50), key=lambda r: -r["at"]):
            right, n = right + r["right"], n + r["n"]
            if n >= LEAST and right >= PRECISION * n:
                never[kind] = r["at"] / 100
    return model, never


def personal_data(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans and n_added of every row of ``docs`` (doc_id, text).

    The texts are read once: base spans and proposals with their features are
    small arrays, stored, from which the trees are fitted (on weak labels, by
    the base rule), calibrated and applied, a row by itself.  No step deals
    rows by a key but aggregates that combine before the shuffle.

    The counts and the digest are of base spans; ``spans`` has what the method
    adds too, which may lie over a base span of its kind or another added one.
    Places are code points.  Null or empty text: no spans, the digest of the
    empty string.  Null or repeated ids and equal rows: a row each.  Nothing
    to learn from (one label only, or an empty table): nothing is added.
    """
    found = stored(candidates(docs), "proposals")
    model, least = fit(found)
    base, kinds = F.col("base"), range(len(KINDS))
    place = lambda c: F.struct(c["kind"].alias("kind"), c["start"].alias("start"), c["end"].alias("end"))
    if min(least) <= 1:
        levels = F.array(*[F.lit(x) for x in least])
        added = F.transform(F.filter("proposals", lambda c: c["open"] & (_score(model, c["features"]) >= F.get(levels, c["kind"]))), place)
        every = F.array_sort(F.array_distinct(F.concat(base, added)))
    else:
        every = base
    names = F.array(*[F.lit(k) for k in KINDS])
    said = lambda spans: F.array_join(F.transform(
        spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")
    many = [_count_of(k).alias(f"n_{KINDS[k]}") for k in kinds]
    return found.select("doc_id", *many, F.sha2(said(base), 256).alias("base_sha256"), said(every).alias("spans"),
                        (F.size(every) - F.size(base)).cast("long").alias("n_added"))


def _count_of(kind: int) -> Column:
    return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
