"""Personal data: spans of emails, IP addresses, payment cards and phone numbers.

Base patterns with their checks find the plain forms, and these spans always stay. Beyond
them, generators of high recall propose further spans, which may overlap: numbers in other
notations, IPv6 addresses, emails written with (at) and (dot). Boosted trees judge each by
features of its format and of the text around it, and a threshold per kind, calibrated for
precision on all candidates of the texts that the trees have not seen, selects the ones to add.

There are no labels, so the trees learn from the base rules: candidates are positive that
overlap a base span of their kind, or would be one in plain notation. Forms that no base rule
knows have rules of their own: IPv6 addresses that parse, and national phone numbers and
emails in words ("jo at mail dot org") after a clue such as "call" or "write". Base values
rewritten in all of these notations are positive too; all other candidates are negative.

Everything on the rows is a column expression, trees included, so a document is one row
from start to end and texts are not shuffled; only a bounded sample of candidates of each
kind is gathered to train on. Positions count code points.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orestrata.sources.scratch import materialize

KINDS = ("email", "ip", "card", "phone")
_PLACE_SEED = 29

# The base patterns. Possessive quantifiers and looks behind change no match;
# they spare retries, and recursion on long runs. An email begins where its run of characters
# does, or where the match before it ended.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9]++(?:[\x20-][0-9]++)*+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_AT = r"(?:\s?(?:@|\(at\)|\[at\])\s?|\s+at\s+)"
_DOT = r"(?:\.|\s?(?:\(dot\)|\[dot\])\s?|\s+dot\s+)"
GENERATORS = {
    "email": rf"(?i)(?<![\p{{L}}0-9._%+-])[\p{{L}}0-9._%+-]{{1,64}}+{_AT}[\p{{L}}0-9-]{{1,63}}(?:{_DOT}[\p{{L}}0-9-]{{1,63}}){{1,6}}",
    "ip": r"(?<![0-9A-Fa-f:.])(?:(?:[0-9A-Fa-f]{0,4}:){2,7}[0-9A-Fa-f]{1,4}|[0-9]{1,3}(?:\x20?\.\x20?[0-9]{1,3}){3})(?![0-9A-Fa-f:])",
    "card": r"(?<![0-9])[0-9](?:[\x20./-]{0,2}[0-9]){12,18}(?![0-9])",
    "phone": r"(?<![0-9+])(?:\+|00)?\(?[0-9](?:[\x20()./-]{0,3}[0-9]){6,14}(?![0-9])",
}
# What a text must hold to match a pattern: quick to look for, and rare. Where a match has
# digits, they are looked for first: not in emails, nor in IPv6 addresses.
BASE_HINTS = {
    "email": "@",
    "ip": r"[0-9]\.[0-9]",
    "card": r"[0-9](?:[\x20-]?[0-9]){13}",
    "phone": r"\+[0-9]",
}
GENERATOR_HINTS = {
    "email": r"(?i)@|[(\[]at[)\]]|\sat\s+[\p{L}0-9-]+(?:\.[\p{L}0-9-]|\s*[(\[]?dot)",
    "ip": r"[0-9]\x20?\.\x20?[0-9]|:[0-9A-Fa-f]{0,4}:",
    "card": r"[0-9](?:[\x20./-]{0,2}[0-9]){12}",
    "phone": r"[0-9](?:[\x20()./-]{0,3}[0-9]){6}",
}
# Whole IPv6 addresses, with a digit or three groups, as program text also has `a::b`.
_GROUP = "[0-9A-Fa-f]{1,4}"
_IPV6 = (
    rf"^(?=.*[0-9]|:*(?:[^:]+:+){{2}}[^:])(?:(?:{_GROUP}:){{7}}{_GROUP}"
    rf"|(?=.*::)(?!.*::.*::)(?!.*:::)(?!:[^:])(?:[0-9A-Fa-f]{{0,4}}:){{2,7}}{_GROUP})$"
)
# A dot in words, or an "at" in words with a bracketed dot: "us at example.org" may be a place.
_WORDED = r"(?i)(?:@|[(\[]at[)\]]|\sat\s).*\sdot\s|\sat\s.*[(\[]dot[)\]]"
# No national phone numbers: a country code, dates, IPv4.
_NOT_NATIONAL = (
    r"^(?:\+|00|(?:19|20)[0-9]{2}[./-][0-9]{1,2}[./-]|[0-9]{1,2}[./-][0-9]{1,2}[./-](?:19|20)[0-9]{2}(?![0-9])"
    r"|[0-9]{1,3}(?:\.[0-9]{1,3}){3}$)"
)
CONTEXT = 32
# Matches that are placed in one go: a fold copies the list that it adds to.
SPAN_BLOCK = 256
# Characters of a text that are cut from at once.
CHUNK = 1024
CLUES = {
    "email": r"(?i)e-?mail|contact|write|schreib|courriel|correo",
    "ip": r"(?i)\bip\b|address|server|host|adresse|servidor",
    "card": r"(?i)card|visa|credit|payment|karte|carte|tarjeta",
    "phone": r"(?i)phone|call|tel|fax|mobile|anruf|appel|llam",
}


@dataclass(frozen=True)
class Training:
    """`candidates`: of each kind, sampled at most to train on, from half of the texts.
    `precision`: share of base-like spans among those a threshold lets through."""

    candidates: int = 8_000
    trees: int = 8
    depth: int = 3
    precision: float = 0.99
    seed: int = 5


@dataclass(frozen=True)
class Detector:
    """Trained trees as (weight, nested splits), and the least score per kind to be added."""

    trees: tuple
    thresholds: dict[str, float]


def spans(kind: str, values: Column, pieces: Column) -> Column:
    """Spans from the matches of a pattern and the pieces of text around them, both null if
    there are none: structs of kind, start, end, value, and the text `before` and `after`
    within reach."""
    zipped = F.arrays_zip(values.alias("value"), pieces.alias("piece"), F.slice(pieces, 2, F.size(values)).alias("next"))
    zipped = F.slice(zipped, 1, F.size(values))
    nothing = F.expr(
        "CAST(array() AS array<struct<kind:string,start:int,end:int,value:string,before:string,after:string>>)"
    )

    def step(done: Column, one: Column) -> Column:
        start = done["at"] + F.length(one["piece"])
        end = start + F.length(one["value"])
        span = F.struct(
            F.lit(kind).alias("kind"),
            start.alias("start"),
            end.alias("end"),
            one["value"].alias("value"),
            F.right(one["piece"], F.lit(CONTEXT)).alias("before"),
            F.left(one["next"], F.lit(CONTEXT)).alias("after"),
        )
        return F.struct(end.alias("at"), F.concat(done["spans"], F.array(span)).alias("spans"))

    def placed(block: Column, at: Column) -> Column:
        return F.aggregate(block, F.struct(at.alias("at"), nothing.alias("spans")), step, lambda done: done["spans"])

    def length(block: Column) -> Column:
        return F.aggregate(block, F.lit(0), lambda n, one: n + F.length(one["piece"]) + F.length(one["value"]))

    # In two levels, first the places of blocks, then those of their matches, as one fold
    # over all would take time with the square of their number.
    firsts = F.sequence(F.lit(1), F.size(values), F.lit(SPAN_BLOCK))
    blocks = F.transform(firsts, lambda first: F.slice(zipped, first, F.lit(SPAN_BLOCK)))
    blocks = F.transform(blocks, lambda block: F.struct(block.alias("rows"), length(block).alias("length")))
    starts = F.aggregate(
        blocks, F.struct(F.lit(0).alias("at"), F.expr("CAST(array() AS array<int>)").alias("all")),
        lambda done, block: F.struct((done["at"] + block["length"]).alias("at"), F.concat(done["all"], F.array(done["at"])).alias("all")),
        lambda done: done["all"],
    )
    found = F.flatten(F.zip_with(blocks, starts, lambda block, at: placed(block["rows"], at)))
    return F.when(F.size(pieces) > 0, found).otherwise(nothing)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _octet(part: Column) -> Column:
    plain = F.regexp_replace(part, "^0+", "")
    return (F.length(plain) < 3) | ((F.length(plain) == 3) & (plain <= "255"))


def _holds(span: Column, kind: str) -> Column:
    """Whether a match of a base pattern passes its check."""
    value = span["value"]
    if kind == "ip":
        return F.forall(F.split(value, r"\."), _octet)
    if kind == "card":
        digits = _digits(value)
        return F.length(digits).between(14, 19) & F.call_function("luhn_check", digits)
    if kind == "phone":
        return F.length(_digits(value)).between(10, 15)
    return F.lit(True)


def _checked(found: Column, kind: str) -> Column:
    return F.filter(found, lambda span: _holds(span, kind))


def _plainly_valid(span: Column) -> Column:
    """Whether a candidate, put into plain notation, is what a base rule accepts."""
    value = span["value"]
    at, dot = r"\s?[(\[](?i:at)[)\]]\s?", r"\s?[(\[](?i:dot)[)\]]\s?"
    plain = {
        "email": F.regexp_replace(F.regexp_replace(value, at, "@"), dot, "."),
        "ip": F.regexp_replace(value, r"\s", ""),
        "card": F.regexp_replace(value, "[^0-9]+", "-"),
        "phone": F.regexp_replace(value, "^00", "+"),
    }
    valid = F.lit(False)
    for kind, text in plain.items():
        accepted = F.rlike(text, F.lit(f"^(?:{BASE[kind]})$")) & _holds(F.struct(text.alias("value")), kind)
        valid = F.when(span["kind"] == kind, accepted).otherwise(valid)
    return valid


def _notations(kind: Column, value: Column, before: Column, after: Column) -> dict[str, Column]:
    """Whether a candidate stands alone in a notation that no base rule knows."""
    alone = ~F.rlike(before, F.lit(r"[\p{L}0-9_]$")) & ~F.rlike(after, F.lit(r"^[\p{L}0-9_]"))
    n = F.length(_digits(value))
    grouped = n.between(10, 15) | (n.between(7, 9) & F.rlike(value, F.lit("[0-9][^0-9]+[0-9]")))
    email = F.regexp_replace(F.regexp_replace(value, f"(?i){_AT}", "@"), f"(?i){_DOT}", ".")
    address = F.rlike(email, F.lit(f"^(?:{BASE['email']})$")) & F.rlike(email, F.lit(r"\.[A-Za-z]{2,}$"))
    return {
        "worded": (kind == "email") & F.rlike(value, F.lit(_WORDED)) & address & alone,
        "ipv6": (kind == "ip") & F.rlike(value, F.lit(_IPV6)) & alone,
        "national": (kind == "phone") & grouped & ~F.rlike(value, F.lit(_NOT_NATIONAL)) & alone,
    }


def _clue(kind: Column, before: Column) -> Column:
    return reduce(lambda rest, k: F.when(kind == k, F.rlike(before, F.lit(CLUES[k]))).otherwise(rest), KINDS, F.lit(False))


def _valid_beyond_base(span: Column) -> Column:
    """Whether a candidate in a notation that no base rule knows counts as positive."""
    holds = _notations(span["kind"], span["value"], span["before"], span["after"])
    return holds["ipv6"] | ((holds["worded"] | holds["national"]) & _clue(span["kind"], span["before"]))


def features(kind: Column, value: Column, before: Column, after: Column) -> dict[str, Column]:
    """Numbers that describe a candidate's format and context."""

    def count(pattern: str, of: Column = value) -> Column:
        return F.regexp_count(of, F.lit(pattern))

    def flag(condition: Column) -> Column:
        return F.coalesce(condition, F.lit(False)).cast("int")

    digits = _digits(value)
    found = {
        **{f"is_{k}": flag(kind == k) for k in KINDS},
        "length": F.length(value),
        "digits": F.length(digits),
        "letters": count(r"\p{L}"),
        "groups": count("[0-9]+"),
        "dots": count(r"\."),
        "colons": count(":"),
        "other_signs": count(r"[^\p{L}0-9.:\x20-]"),
        "blanks": count(r"\s"),
        "spelled_out": count(r"(?i)[(\[](?:at|dot)[)\]]"),
        "international": flag(F.rlike(value, F.lit(r"^(?:\+|00)[1-9]"))),
        "bracketed": flag(F.rlike(value, F.lit(r"\([0-9]{2,4}\)"))),
        "issuer": flag(F.rlike(digits, F.lit("^[3-6]"))),
        "checksum": flag((F.length(digits) > 0) & F.call_function("luhn_check", digits)),
        "in_range": flag(F.forall(F.split(value, r"\."), lambda p: F.rlike(p, F.lit("^[0-9]{1,3}$")) & _octet(p))),
        "joined_before": flag(F.rlike(before, F.lit(r"[\p{L}0-9_=\"/]$"))),
        "joined_after": flag(F.rlike(after, F.lit(r"^[\p{L}0-9_=\"/]"))),
        "digits_around": count("[0-9]", F.concat(before, after)),
        "clue": flag(_clue(kind, before)),
        **{name: flag(holds) for name, holds in _notations(kind, value, before, after).items()},
    }
    return {name: number.cast("double") for name, number in found.items()}


def _given(value: Column, body) -> Column:
    """`body` of a value that is computed once, however often it is used there."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def running_max(numbers: Column) -> Column:
    """For each of an array of whole numbers the largest up to and with it.

    In two levels, within blocks and over the largest of each block.
    """
    size = F.lit(SPAN_BLOCK)

    def reached(v: Column) -> Column:
        blocks = F.sequence(F.lit(0), F.greatest(F.lit(0), ((F.size(v) - 1) / size).cast("int")))
        tops = F.transform(blocks, lambda b: F.array_max(F.slice(v, b * size + 1, size)))
        return _given(tops, lambda t: F.transform(t, lambda _, b: F.array_max(F.slice(t, F.lit(1), b + 1))))

    def whole(v: Column, tops: Column) -> Column:
        def up_to(_: Column, i: Column) -> Column:
            inside = F.array_max(F.slice(v, i - i % size + 1, i % size + 1))
            return F.greatest(inside, F.get(tops, (i / size).cast("int") - 1))

        return F.transform(v, up_to)

    return _given(numbers, lambda v: _given(reached(v), lambda tops: whole(v, tops)))


def _marked(candidates: Column, base: Column) -> Column:
    """The candidates as (span, meets): whether one overlaps a base span.

    In order of a candidate's end and a base span's start, the base spans that lie before a
    candidate begin before its end; it overlaps one if the furthest of their ends is past its
    start.
    """

    def event(at: Column, turn: int, reach: Column, start: Column, i: Column) -> Column:
        return F.struct(at.alias("at"), F.lit(turn).alias("turn"), reach.alias("reach"), start.alias("start"), i.alias("i"))

    def meeting(events: Column) -> Column:
        def marked(reach: Column) -> Column:
            every = F.transform(events, lambda e, i: F.struct(e["turn"].alias("turn"), e["i"].alias("i"), (F.get(reach, i) > e["start"]).alias("meets")))
            return F.filter(every, lambda e: e["turn"] == 0)

        return _given(running_max(F.transform(events, lambda e: e["reach"])), marked)

    def spans(given: Column) -> Column:
        ends = F.transform(given, lambda c, i: event(c["end"], 0, F.lit(0), c["start"], i))
        starts = F.transform(base, lambda b, i: event(b["start"], 1, b["end"], b["start"], i))
        found = _given(F.array_sort(F.concat(ends, starts)), meeting)
        return F.transform(found, lambda m: F.struct(F.get(given, m["i"]).alias("span"), m["meets"].alias("meets")))

    return _given(candidates, spans)


def _best_apart(chosen: Column) -> Column:
    """Of spans with a score, those that overlap no better one: a higher score, then the
    earliest, then the smallest kind. Spans of one kind must not overlap each other.

    In order of their starts a span overlaps an earlier one only if that one is the last of
    its kind so far and ends later than the span starts, so the pairs to settle are few.
    """
    rank = lambda s: F.struct(-s["score"], s["start"], s["kind"])

    def settled(ordered: Column) -> Column:
        def worse(last: Sequence[Column]) -> Column:
            def of_pair(s: Column, i: Column, before: Column) -> Column:
                other = F.get(ordered, before)
                loser = F.when(rank(other) < rank(s), i).otherwise(before)
                return F.when((before >= 0) & (other["end"] > s["start"]), loser)

            # The last of a kind before a span: up to the span before it.
            pairs = lambda s, i: F.array(*[of_pair(s, i, F.get(k, i - 1)) for k in last])
            return F.flatten(F.transform(ordered, pairs))

        def last_of(kind: str) -> Column:
            return running_max(F.transform(ordered, lambda s, i: F.when(s["kind"] == kind, i).otherwise(F.lit(-1))))

        lasts = F.struct(*[last_of(k).alias(k) for k in KINDS])
        losers = _given(lasts, lambda last: worse([last[k] for k in KINDS]))
        stay = F.array_except(F.transform(ordered, lambda _, i: i), losers)
        return F.transform(stay, lambda i: F.get(ordered, i))

    by_start = F.array_sort(F.transform(chosen, lambda s: F.struct(s["start"].alias("start"), s.alias("span"))))
    return _given(F.transform(by_start, lambda s: s["span"]), settled)


def _spans_of(docs: DataFrame, carried: Column, name: str) -> DataFrame:
    """`carried` as `name`, the text (null as empty) as `content`, its `base` spans and its
    `candidates`, as from `spans`: leftmost matches of each pattern that do not overlap.

    Each column builds on the ones before, so a pattern runs only on texts that may match,
    and once more to cut those that do.
    """
    text, digit = F.col("content"), F.col("digit")
    rows = docs.select(carried.alias(name), F.coalesce("text", F.lit("")).alias("content"))
    rows = rows.withColumn("digit", F.rlike(text, F.lit("[0-9]")))
    patterns = {("base", k): (BASE[k], BASE_HINTS[k]) for k in KINDS}
    patterns |= {("candidates", k): (GENERATORS[k], GENERATOR_HINTS[k]) for k in KINDS}
    values, pieces, results = {}, {}, {"base": [], "candidates": []}
    for (group, kind), (pattern, hint) in patterns.items():
        column = f"{group}_{kind}"
        hinted = F.rlike(text, F.lit(hint))
        if kind != "email" and column != "candidates_ip":
            hinted = digit & hinted
        values[column] = F.when(hinted, F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))
        pieces[f"{column}_cut"] = F.when(F.size(column) > 0, F.split(text, pattern, -1))
        found = spans(kind, F.col(column), F.col(f"{column}_cut"))
        results[group].append(_checked(found, kind) if group == "base" else found)
    rows = rows.withColumns(values).withColumns(pieces)
    return rows.select(name, "content", *[F.concat(*parts).alias(group) for group, parts in results.items()])


def _rewritten() -> Column:
    """A positive candidate as it is, in `own`, and in other notations: (new, value, before),
    new ones being those that no base rule knows, behind a clue if they need one."""
    kind, value = F.col("kind"), F.col("value")

    def form(text: Column, clue: str = "", new: bool = False) -> Column:
        return F.struct(F.lit(new).alias("new"), text.alias("value"), F.concat("before", F.lit(clue)).alias("before"))

    spelled = F.regexp_replace(F.regexp_replace(value, "@", " (at) "), r"\.", " (dot) ")
    bracketed = F.regexp_replace(F.regexp_replace(value, "@", "[at]"), r"\.", "[dot]")
    host = F.regexp_replace(F.substring_index(value, "@", -1), r"\.", " dot ")
    worded = F.concat(F.substring_index(value, "@", 1), F.lit(" at "), host)
    parts = F.split(F.regexp_replace(value, r"\s", ""), r"\.")
    pairs = [F.lower(F.hex(F.get(parts, i).try_cast("bigint") * 256 + F.get(parts, i + 1).try_cast("bigint"))) for i in (0, 2)]
    national = F.regexp_replace(value, r"^\+[0-9]{1,2}[\x20.-]*", "")
    return (
        F.when(kind == "email", F.array("own", form(spelled), form(bracketed), form(worded, " write to ", True)))
        .when(
            kind == "phone",
            F.array("own", form(F.regexp_replace(value, r"^\+", "00")), form(national, " call ", True)),
        )
        .when(kind == "card", F.array("own", form(F.regexp_replace(value, "[^0-9]", "."))))
        .when(
            (kind == "ip") & (F.size(parts) == 4),
            F.array(
                "own",
                form(F.concat_ws(":", F.lit("2001:db8::ffff"), *pairs), " ", True),
                form(F.concat_ws(":", F.lit("2001:db8:0:0:0:ffff"), *pairs), " ", True),
            ),
        )
        .otherwise(F.array("own"))
    )


# The sample of a kind is drawn in so many parts, so that no task gathers all of it.
_PARTS = 64


def _with_place(docs: DataFrame) -> DataFrame:
    """Texts with a hash that equal texts share, so that they are all trained on or none."""
    return docs.select("text", F.xxhash64(F.lit(_PLACE_SEED), F.coalesce("text", F.lit(""))).alias("place"))


def _labelled(docs: DataFrame) -> DataFrame:
    """One row per candidate of texts with a place: place, the span's columns, whether it is
    `plain`, as by the base rules, and its `label`."""
    spans = _spans_of(docs, F.col("place"), "place")

    def of_kind(group: str, kind: str) -> Column:
        return F.filter(group, lambda s: s["kind"] == kind)

    marked = F.concat(*[_marked(of_kind("candidates", k), of_kind("base", k)) for k in KINDS])
    spans = spans.select("place", F.explode(marked).alias("m")).select("place", F.col("m.span").alias("c"), "m.meets")
    plain = F.col("meets") | _plainly_valid(F.col("c"))
    return spans.select("place", "c.*", plain.alias("plain"), (plain | _valid_beyond_base(F.col("c"))).alias("label"))


def _training_rows(docs: DataFrame, training: Training) -> DataFrame:
    """A bounded sample of the candidates of each kind with features and label: a written table.

    Texts of even places are drawn from, and there the candidates with the smallest hashes of
    text and position in each part of a kind; of equal texts one.
    """
    sample = _labelled(_with_place(docs).filter("place % 2 = 0"))
    order = F.xxhash64(F.lit(training.seed), "place", "kind", "start", "value")
    sample = sample.withColumn("order", order).withColumn("part", F.pmod("order", F.lit(_PARTS)))
    first = F.row_number().over(Window.partitionBy("kind", "part").orderBy("order", "value", "start"))
    sample = sample.dropDuplicates(["place", "kind", "start", "value"]).withColumn("first", first)
    sample = sample.filter(F.col("first") <= max(1, training.candidates // _PARTS))

    sample = sample.withColumn("own", F.struct(F.lit(False).alias("new"), "value", "before"))
    rows = sample.withColumn("as", F.explode(F.when(F.col("plain"), _rewritten()).otherwise(F.array("own"))))
    numbers = features(F.col("kind"), F.col("as.value"), F.col("as.before"), F.col("after"))
    whole = reduce(lambda a, b: a | b, _notations(F.col("kind"), F.col("as.value"), F.col("as.before"), F.col("after")).values())
    rows = rows.filter(~F.col("as.new") | whole)
    label = F.col("label").cast("double").alias("label")
    return materialize(rows.select("place", "kind", label, *[c.alias(n) for n, c in numbers.items()]), "pii")


def _splits(node, names: Sequence[str]):
    """A trained tree as nested (feature, threshold, if at most, else), leaves as numbers."""
    if node.numDescendants() == 0:
        return node.prediction()
    split = node.split()
    children = _splits(node.leftChild(), names), _splits(node.rightChild(), names)
    return names[split.featureIndex()], split.threshold(), *children


def _tree_value(tree, number: dict[str, Column]) -> Column:
    if not isinstance(tree, tuple):
        return F.lit(float(tree))
    name, threshold, low, high = tree
    return F.when(number[name] <= threshold, _tree_value(low, number)).otherwise(_tree_value(high, number))


def score(trees: Sequence[tuple[float, object]], numbers: dict[str, Column]) -> Column:
    """Probability that the trees give."""
    margin = reduce(lambda a, b: a + b, [_tree_value(tree, numbers) * F.lit(float(w)) for w, tree in trees])
    return 1 / (1 + F.exp(-2 * margin))


def train(docs: DataFrame, training: Training = Training()) -> Detector | None:
    """A detector from the documents themselves; None if they hold no example of one class."""
    rows = _training_rows(docs, training)
    names = [c for c in rows.columns if c not in ("place", "kind", "label")]
    if rows.select("label").distinct().count() < 2:
        return None
    gathered = VectorAssembler(inputCols=names, outputCol="features").transform(rows)
    learner = GBTClassifier(maxIter=training.trees, maxDepth=training.depth, seed=training.seed, maxBins=32)
    # In one order, as the splits tried depend on it.
    model: GBTClassificationModel = learner.fit(gathered.coalesce(1).sortWithinPartitions("place", "kind", *names))
    trees = tuple(
        (weight, _splits(tree._java_obj.rootNode(), names)) for weight, tree in zip(model.treeWeights, model.trees, strict=True)
    )
    # All texts but those drawn from, which are bounded by the sample.
    drawn = F.broadcast(rows.select("place").distinct())
    held_out = _labelled(_with_place(docs).join(drawn, "place", "left_anti"))
    numbers = features(*map(F.col, ("kind", "value", "before", "after")))
    held_out = held_out.select("kind", F.col("label").cast("int").alias("label"), *[c.alias(n) for n, c in numbers.items()])
    scored = held_out.select("kind", "label", F.round(score(trees, {n: F.col(n) for n in names}), 3).alias("score"))
    # At most a thousand scores per kind reach the driver.
    counts = scored.groupBy("kind", "score").agg(F.sum("label").alias("good"), F.count(F.lit(1)).alias("n")).collect()
    thresholds = {}
    for kind in KINDS:
        good = total = 0
        for row in sorted((r for r in counts if r.kind == kind), key=lambda r: -r.score):
            good, total = good + row.good, total + row.n
            if good >= training.precision * total:
                thresholds[kind] = row.score
    return Detector(trees, thresholds)


def find_spans(docs: DataFrame, detector: Detector | None, carried: Column, name: str) -> DataFrame:
    """`carried` as `name`, `content` (the text, null as empty), `base` and `spans`: both arrays of (start, place, end, kind) in order of start, then kind."""
    rows = _spans_of(docs, carried, name)

    def bare(span: Column) -> Column:
        place = F.array_position(F.array(*map(F.lit, KINDS)), span["kind"]).cast("int")
        return F.struct(span["start"].alias("start"), place.alias("place"), span["end"].alias("end"), span["kind"].alias("kind"))

    base = F.array_sort(F.transform("base", bare))
    if detector is None:
        return rows.withColumn("base", base).withColumn("spans", F.col("base")).drop("candidates")

    apart = F.transform(F.filter(_marked(F.col("candidates"), F.col("base")), lambda m: ~m["meets"]), lambda m: m["span"])

    def described(c: Column) -> Column:
        numbers = features(c["kind"], c["value"], c["before"], c["after"])
        return F.struct(
            c["start"].alias("start"), c["end"].alias("end"), c["kind"].alias("kind"),
            F.struct(*[n.alias(name) for name, n in numbers.items()]).alias("numbers"),
        )

    names = list(features(*[F.lit("")] * 4))
    def needed(kind: Column) -> Column:
        return reduce(
            lambda rest, k: F.when(kind == k, F.lit(float(detector.thresholds[k]))).otherwise(rest), detector.thresholds, F.lit(2.0)
        )

    def scored(c: Column) -> Column:
        value = F.round(score(detector.trees, {n: c["numbers"][n] for n in names}), 3)
        return F.struct(value.alias("score"), c["start"].alias("start"), c["end"].alias("end"), c["kind"].alias("kind"))

    chosen = F.filter(F.transform(F.transform(apart, described), scored), lambda c: c["score"] >= needed(c["kind"]))
    rows = rows.withColumn("base", base).withColumn("chosen", chosen)
    return rows.withColumn("spans", F.array_sort(F.concat("base", F.transform(_best_apart(F.col("chosen")), bare)))).drop("candidates", "chosen")


def written(spans: Column) -> Column:
    """`kind:start:end` of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redacted(text: Column, spans: Column) -> Column:
    """The text with each span, or run of overlapping spans, replaced by its first kind.

    Pieces are cut from the few chunks that hold them, as every cut counts its way from the
    start, and joined at once.
    """

    def between(chunks: Column, start: Column, end: Column) -> Column:
        first, size = (start / CHUNK).cast("int"), F.lit(CHUNK)
        held = F.slice(chunks, first + 1, (end / CHUNK).cast("int") - first + 1)
        return F.substring(F.array_join(held, ""), start % size + 1, end - start)

    def pieces(chunks: Column, reach: Column) -> Column:
        def piece(span: Column, i: Column) -> Column:
            at = F.coalesce(F.get(reach, i - 1), F.lit(0))
            mark = F.concat(between(chunks, at, span["start"]), F.lit("["), F.upper(span["kind"]), F.lit("]"))
            return F.when(span["start"] >= at, mark).otherwise(F.lit(""))

        return F.concat(F.transform(spans, piece), F.array(between(chunks, F.array_max(reach), F.length(text))))

    chunks = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{CHUNK}}}"), F.lit(0))
    reach = running_max(F.transform(spans, lambda s: s["end"]))
    whole = F.array_join(_given(chunks, lambda c: _given(reach, lambda r: pieces(c, r))), "")
    return F.when(F.size(spans) == 0, text).otherwise(whole)


def detect(docs: DataFrame, training: Training = Training()) -> DataFrame:
    """One row per document: doc_id, base and spans, arrays of (start, place, end, kind), and
    content, the text that they refer to.

    Null text is empty and has no spans; null doc_ids and repeated rows are judged like any
    others. Texts of any length are searched whole. Other columns are ignored. An empty
    table gives an empty result. Writes the training sample to the shared folder.
    """
    return find_spans(docs, train(docs, training), F.col("doc_id"), "doc_id")


def redact(docs: DataFrame, training: Training = Training()) -> DataFrame:
    """`docs` with every span in `text` replaced by `[KIND]`; all else as it was."""
    found = find_spans(docs, train(docs, training), F.struct("*"), "row")
    changed = F.when(F.size("spans") > 0, redacted(F.col("content"), F.col("spans"))).otherwise(F.col("row.text"))
    return found.select(*[changed.alias(c) if c == "text" else F.col(f"row.`{c}`") for c in docs.columns])
