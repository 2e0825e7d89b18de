"""Personal data: fixed shapes, and contexts bootstrapped from them, with DataFrame functions only.

Emails, addresses, card and phone numbers are found by shape. They are the seeds. The words
before a seed are its lexical patterns: the last word, and the last two, whole. A graph joins patterns
with their instances: seeds, and other words that look like identifiers. It is scored in rounds:
a pattern is as trustworthy as the share of known instances among *all* words that follow it
anywhere, an instance as 1 - prod(1 - trust) over its patterns. Patterns need several different
instances. What ends above ``ACCEPTED`` after a trusted pattern is a further span.

Positions come from splitting a text by a pattern: lengths of the pieces and of the matches add
up to code points. Repetitions are possessive, so long runs need no stack.

Defined results: null and empty texts have no spans. An empty table gives no rows; without seeds
no pattern is trusted. Repeated rows are scanned each, and count as often in the graph. Rows with
a null id, or with one id and different texts, get their own spans each. Words are whole at any
length; a span that begins inside a word has no pattern.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from afterplay.llm.components import written
from afterplay.llm.winnow import SPACE, let

# fixed values: the shapes of personal data
EMAIL = r"[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
IP_PART = r"0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
KINDS = ("email", "ip", "card", "phone")

#: a word with a digit or a sign of an address in it looks like an identifier; a match is a whole word
IDENTIFIER = r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9@_]*+[0-9@_][^\x20\x09-\x0D]*+"
SHORTEST_IDENTIFIER = 5
LAST_WORDS = r"(?:^|[\x20\x09-\x0D])([^\x20\x09-\x0D]+)[\x20\x09-\x0D]+([^\x20\x09-\x0D]+)[\x20\x09-\x0D]+$"
LAST_WORD = r"(?:^|[\x20\x09-\x0D])([^\x20\x09-\x0D]+)[\x20\x09-\x0D]+$"

ROUNDS = 3
LEAST_INSTANCES = 4
PATTERNS = 50_000
TRUSTED = 0.5
ACCEPTED = 0.7
BLOCK = 64


def found(text: Column, pattern: str, more: Callable[[Column, Column], Column] | None = None) -> Column:
    """Array of (start, value) of all matches; ``more(pieces, matches)`` gives one further value, ``patterns``, for each."""

    def spans(pieces: Column, matches: Column) -> Column:
        widths = F.transform(matches, lambda m, i: F.char_length(F.get(pieces, i)) + F.char_length(m))
        placed = let(widths, lambda w: let(_block_sums(w), lambda sums: _placed(pieces, matches, w, sums)))
        if more is None:
            return placed
        return F.zip_with(placed, more(pieces, matches), lambda s, x: F.struct(s["start"], s["value"], x.alias("patterns")))

    return let(F.split(text, pattern, -1), lambda p: let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda m: spans(p, m)))


def identifiers(text: Column) -> Column:
    """Array of (start, value, patterns) of the words that look like identifiers."""
    return found(text, IDENTIFIER, _patterns)


def _total(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0).cast("bigint"), lambda total, n: total + n)


def _block_sums(widths: Column) -> Column:
    blocks = F.sequence(F.lit(0), F.floor(F.size(widths) / BLOCK).cast("int"))
    return F.transform(blocks, lambda b: _total(F.slice(widths, b * BLOCK + 1, BLOCK)))


def _placed(pieces: Column, matches: Column, widths: Column, sums: Column) -> Column:
    """The start of a match is what the blocks before it, and its own block, add up to."""

    def one(match: Column, i: Column) -> Column:
        block = F.floor(i / BLOCK).cast("int")
        earlier = _total(F.slice(sums, 1, block)) + _total(F.slice(widths, block * BLOCK + 1, i - block * BLOCK))
        return F.struct(
            (earlier + F.char_length(F.get(pieces, i))).alias("start"),
            match.alias("value"),
        )

    return F.transform(matches, one)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(value: Column) -> Column:
    """Every second digit from the right is doubled, its digits are added; the sum ends in 0."""

    def add(total: Column, i: Column, digits: Column) -> Column:
        digit = F.substring(digits, -i, F.lit(1)).cast("int")
        twice = digit * 2
        doubled = F.when(twice > 9, twice - 9).otherwise(twice)
        return total + F.when(i % 2 == 0, doubled).otherwise(digit)

    total = let(
        _digits(value),
        lambda d: F.aggregate(F.sequence(F.lit(1), F.char_length(d)), F.lit(0), lambda t, i: add(t, i, d)),
    )
    return total % 10 == 0


def _kept(text: Column, kind: str, place: int, pattern: str, holds: Callable[[Column], Column]) -> Column:
    def span(s: Column) -> Column:
        return F.struct(
            s["start"].alias("start"), F.lit(place).alias("place"), F.lit(kind).alias("kind"),
            (s["start"] + F.char_length(s["value"])).alias("end"), s["value"].alias("value"),
        )

    return F.transform(F.filter(found(text, pattern), lambda s: holds(s["value"])), span)


def base_spans(text: Column) -> Column:
    """Array of (start, place, kind, end, value) by start, then kind."""
    size = F.char_length
    rules = {
        "email": (EMAIL, text.contains("@"), lambda v: F.lit(True)),
        "ip": (IP, text.rlike(r"[0-9]\.[0-9]"), lambda v: v.rlike(rf"^{IP_PART}(?:\.{IP_PART}){{3}}$")),
        "card": (CARD, text.rlike(r"[0-9][\x20-]?[0-9]"), lambda v: size(_digits(v)).between(14, 19) & _luhn(v)),
        "phone": (PHONE, text.rlike(r"\+[0-9]"), lambda v: size(_digits(v)).between(10, 15)),
    }
    spans = "array<struct<start:bigint,place:int,kind:string,end:bigint,value:string>>"
    parts = [
        F.when(rules[kind][1], _kept(text, kind, place, rules[kind][0], rules[kind][2])).otherwise(F.array().cast(spans))
        for place, kind in enumerate(KINDS)
    ]
    return F.array_sort(F.concat(*parts))


def _normal(text: Column) -> Column:
    return F.translate(F.lower(text), "123456789", "000000000")


def _patterns(pieces: Column, matches: Column) -> Column:
    """For each match, hashes of the two whole words before it, and of the one word before it.

    Matches are whole words, so pieces hold whole words too: the words before a match are the last
    ones of its piece, or the match before it, or the last word of the piece before that one.
    """

    def word(piece: Column, pattern: str, group: int) -> Column:
        return F.nullif(F.regexp_extract(piece, pattern, group), F.lit(""))

    last = F.transform(
        pieces, lambda p: F.struct(_normal(word(p, LAST_WORD, 1)).alias("one"), _normal(word(p, LAST_WORDS, 1)).alias("two"))
    )

    def of(ends: Column, i: Column) -> Column:
        def match(back: int) -> Column:
            return F.when(i >= back, _normal(F.get(matches, i - back)))

        here, before = F.get(ends, i), F.when(i >= 1, F.get(ends, i - 1))
        one = F.coalesce(here["one"], match(1))
        two = F.when(here["one"].isNotNull(), F.coalesce(here["two"], match(1))).when(
            i >= 1, F.coalesce(before["one"], match(2))
        )
        return F.filter(
            F.array(
                F.when(two.isNotNull(), F.xxhash64(F.xxhash64(two), F.xxhash64(one))),
                F.when(one.isNotNull(), F.xxhash64(F.xxhash64(one))),
            ),
            lambda p: p.isNotNull(),
        )

    return let(last, lambda ends: F.transform(matches, lambda m, i: of(ends, i)))


def _words_after(texts: DataFrame, patterns: DataFrame) -> DataFrame:
    """``pattern, n``: how many words follow each pattern, over all words of all texts.

    Up to ``PATTERNS`` patterns go to every task, and the words need no shuffle before they are
    counted; with more, the words are counted first and joined then.
    """
    words = F.filter(F.split(_normal(F.col("text")), SPACE), lambda w: w != "")

    def both(h: Column) -> Column:
        def at(word: Column, i: Column) -> Column:
            # the word before the first one is missing: its hash is that of no word
            return F.array(F.xxhash64(F.when(i > 0, F.get(h, i - 1)), word), F.xxhash64(word))

        return F.flatten(F.transform(F.slice(h, 1, F.greatest(F.size(h) - 1, F.lit(0))), at))

    hashes = F.transform(words, lambda w: F.xxhash64(w))
    each = texts.select(F.explode(let(hashes, both)).alias("pattern"))
    n = F.count(F.lit(1)).alias("n")
    if patterns.count() > PATTERNS:
        return each.groupBy("pattern").agg(n).join(patterns, "pattern")
    return each.join(F.broadcast(patterns), "pattern").groupBy("pattern").agg(n)


def bootstrap(occurrences: DataFrame, texts: DataFrame, rounds: int = ROUNDS) -> tuple[DataFrame, DataFrame]:
    """Trusted patterns (pattern, trust) and accepted instances (value, trust).

    ``occurrences`` has ``value, seed, patterns`` of all instances, ``texts`` the column ``text``.
    """
    edges = (
        occurrences.select("value", "seed", F.explode("patterns").alias("pattern"))
        .groupBy("pattern", "value")
        .agg(F.count(F.lit(1)).alias("times"), F.max("seed").alias("seed"))
    )
    edges = written(edges, "pii-edges")
    # the values of a pattern were counted apart, so a pattern many instances share is one sum
    supported = edges.groupBy("pattern").agg(F.count(F.lit(1)).alias("instances"))
    chosen = written(supported.filter(F.col("instances") >= LEAST_INSTANCES).select("pattern"), "pii-patterns")
    followed = written(_words_after(texts, chosen), "pii-followed")
    graph = written(edges.join(followed, "pattern"), "pii-graph")
    trust = graph.groupBy("value").agg(F.max("seed").cast("double").alias("trust"))
    patterns = None
    for _ in range(rounds):
        patterns = written(
            graph.join(trust, "value")
            .groupBy("pattern")
            .agg(
                F.sum(F.col("times") * F.col("trust")).alias("known"),
                F.sum((F.col("trust") > 0).cast("int")).alias("instances"),
                F.first("n").alias("n"),
            )
            .filter(F.col("instances") >= LEAST_INSTANCES)
            .select("pattern", F.least(F.col("known") / (F.col("n") + 1), F.lit(1.0)).alias("sure"))
            .filter(F.col("sure") >= TRUSTED),
            "pii-trust",
        )
        # one pattern alone leaves a little doubt; least() would pass over a missing one
        doubt = F.exp(F.sum(F.log(1 - F.least(F.coalesce("sure", F.lit(0.0)), F.lit(0.999)))))
        trust = written(
            graph.join(patterns, "pattern", "left")
            .groupBy("value")
            .agg(F.max("seed").alias("seed"), (1 - doubt).alias("trust"))
            .select("value", F.when(F.col("seed") == 1, 1.0).otherwise(F.col("trust")).alias("trust")),
            "pii-instances",
        )
    return patterns, trust.filter(F.col("trust") >= ACCEPTED)


def scan(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """``doc_id`` and ``found``: an array of (kind, start, end, value) by start, then kind."""
    rows = docs.select(docs[key].alias("doc_id"), F.coalesce(docs["text"].cast("string"), F.lit("")).alias("text"))
    # what is found by shape, and the look of identifiers; texts with neither are not kept
    looks = F.when(F.col("text").rlike("[0-9@_]"), identifiers(F.col("text")))
    shaped = rows.select("doc_id", base_spans(F.col("text")).alias("base"), looks.alias("looks"))

    def free(s: Column) -> Column:
        end = s["start"] + F.char_length(s["value"])
        return ~F.exists("base", lambda b: (b["start"] < end) & (s["start"] < b["end"])) & (
            F.char_length(s["value"]) >= SHORTEST_IDENTIFIER
        )

    span = "struct<start:bigint,end:bigint,kind:string,value:string,patterns:array<bigint>>"

    def instance(s: Column, end: Column, kind: Column, patterns: Column) -> Column:
        return F.struct(
            s["start"].alias("start"), end.alias("end"), kind.alias("kind"), s["value"].alias("value"), patterns.alias("patterns")
        )

    def of_word(b: Column) -> Column:
        """The patterns of the word that begins where the span does; a span inside a word has none."""
        return F.get(F.filter("looks", lambda s: s["start"] == b["start"]), F.lit(0))["patterns"]

    kept = shaped.select(
        "doc_id",
        F.concat(
            F.transform("base", lambda b: instance(b, b["end"], b["kind"], F.coalesce(of_word(b), F.array().cast("array<bigint>")))),
            F.transform(
                F.filter(F.coalesce("looks", F.array()), free),
                lambda s: instance(s, s["start"] + F.char_length(s["value"]), F.lit(None).cast("string"), s["patterns"]),
            ),
        ).cast(f"array<{span}>").alias("spans"),
    )
    # numbered before they are written, so that a row keeps its number
    kept = written(kept.withColumn("row", F.monotonically_increasing_id()), "pii-spans")
    one = kept.select("row", F.explode("spans").alias("s")).select("row", "s.*")
    occurrences = one.select("value", F.col("kind").isNotNull().cast("int").alias("seed"), "patterns")
    patterns, accepted = bootstrap(occurrences, rows)
    places = one.filter("kind IS NULL").select("row", "start", "end", "value", F.explode("patterns").alias("pattern"))
    further = (
        places.join(patterns.select("pattern"), "pattern", "left_semi")
        .join(accepted.select("value"), "value", "left_semi")
        .select("row", "start", "end", "value").distinct()
        .groupBy("row").agg(F.collect_list(F.struct("start", "end", "value")).alias("further"))
    )
    joined = kept.join(further, "row", "left")

    def plain(s: Column) -> Column:
        place = reduce(lambda a, b: a.when(s["kind"] == b[1], b[0]), enumerate(KINDS[1:], 1), F.when(s["kind"] == KINDS[0], 0))
        return F.struct(s["start"].alias("start"), place.alias("place"), s["kind"].alias("kind"), s["end"].alias("end"), s["value"].alias("value"))

    def learned(s: Column) -> Column:
        return F.struct(s["start"].alias("start"), F.lit(len(KINDS)).alias("place"), F.lit("context").alias("kind"), s["end"].alias("end"), s["value"].alias("value"))

    base = F.transform(F.filter("spans", lambda s: s["kind"].isNotNull()), plain)
    more = F.transform(F.coalesce("further", F.array()), learned)
    return joined.select("doc_id", F.array_sort(F.concat(base, more)).alias("found"))
