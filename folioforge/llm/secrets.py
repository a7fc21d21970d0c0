"""Secret scans through a trigram index (DataFrame operations only)."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from re import _parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioforge.llm.common import kept_table, text_or_empty


@dataclass(frozen=True)
class Rule:
    """A kind of secret.

    regex: its pattern, read alike by Java and Python. value: the group whose length must be at least `least` characters;
    shorter matches are dropped after matching, so they still use up their text.
    """

    kind: str
    regex: str
    value: int = 0
    least: int = 0

    def trigram_query(self) -> frozenset[frozenset[str]]:
        """The rule's Boolean trigram query: any of the sets, of which all trigrams must occur; empty if nothing is mandatory."""
        return required(self.regex)


#: Strings that a piece of a pattern may be enumerated as, and trigrams kept of an alternative (fewer ask for less).
STRINGS, GRAMS = 64, 3
#: Alternatives of sets of trigrams. The empty set of trigrams asks for nothing, so a query that has it says nothing.
Query = frozenset[frozenset[str]]
NOTHING: Query = frozenset([frozenset()])


def grams(text: str) -> frozenset[str]:
    return frozenset(text[i : i + 3] for i in range(len(text) - 2))


def of_strings(strings: frozenset[str]) -> Query:
    """What a text must hold that has one of the strings."""
    return least(frozenset(map(grams, strings)))


def least(query: Query) -> Query:
    """The query without alternatives that ask for more than another one."""
    return frozenset(a for a in query if not any(b < a for b in query))


def both(a: Query, b: Query) -> Query:
    """The conjunction, as alternatives; where these would be many, the stronger of the two stands for it."""
    if len(a) * len(b) <= STRINGS:
        return least(frozenset(x | y for x in a for y in b))
    return max(a, b, key=lambda q: (min(map(len, q)), -len(q)))


def analysed(items) -> tuple[frozenset[str] | None, Query]:
    """A parsed pattern's strings, lower-cased, if these are few, and its trigram query: a concatenation is the
    conjunction of its parts, with strings carried on from part to part; a branch is the disjunction."""
    strings, query = frozenset([""]), NOTHING
    exact = True
    for op, arg in items:
        own, asked = _piece(op, arg)
        if own is not None and len(own) * len(strings) <= STRINGS:
            strings = frozenset(x + y for x in strings for y in own)
        else:
            query, exact = both(both(query, of_strings(strings)), asked), False
            strings = own if own is not None else frozenset([""])
    if exact:
        return strings, of_strings(strings)
    return None, both(query, of_strings(strings))


def _piece(op, arg) -> tuple[frozenset[str] | None, Query]:
    name = str(op)
    if name == "LITERAL":
        return frozenset([chr(arg).lower()]), NOTHING
    if name == "IN":
        return _members(arg), NOTHING
    if name == "SUBPATTERN":
        return analysed(arg[-1])
    if name == "BRANCH":
        parts = [analysed(x) for x in arg[1]]
        strings = None if any(s is None for s, _ in parts) else frozenset().union(*(s for s, _ in parts))
        query = least(frozenset().union(*(q for _, q in parts)))
        return (strings if strings is not None and len(strings) <= STRINGS else None), query
    if name in ("MAX_REPEAT", "MIN_REPEAT", "POSSESSIVE_REPEAT"):
        low, high, inner = arg
        strings, query = analysed(inner)
        if high == 1 and strings is not None:
            return strings | frozenset([""]) if low == 0 else strings, NOTHING if low == 0 else query
        return None, query if low else NOTHING
    if name == "AT":
        return frozenset([""]), NOTHING
    return None, NOTHING  # any character, look-around, back references: nothing is asked for


def _members(items) -> frozenset[str] | None:
    """The characters of a class if they are at most eight, lower-cased."""
    found = set()
    for op, arg in items:
        if str(op) == "LITERAL":
            found.add(chr(arg).lower())
        elif str(op) == "RANGE" and arg[1] - arg[0] < 8:
            found.update(chr(c).lower() for c in range(arg[0], arg[1] + 1))
        else:
            return None
    return frozenset(found) if len(found) <= 8 else None


def required(regex: str) -> Query:
    """The trigram query of a regex; an empty set of alternatives if it has no mandatory trigram."""
    _, query = analysed(_parser.parse(regex))
    if frozenset() in query:
        return frozenset()

    def fewer(alt: frozenset[str]) -> frozenset[str]:
        n, ordered = min(len(alt), GRAMS), sorted(alt)
        return frozenset(ordered[i * (len(alt) - 1) // max(1, n - 1)] for i in range(n))

    return least(frozenset(map(fewer, query)))


# What the scans look for, base kinds first.
BASE = (
    Rule("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 12),
    Rule("access", "AKIA[A-Z0-9]+", 0, 18),
    Rule("hex", "[0-9a-f]+", 0, 16),
)
RULES = (
    *BASE,
    Rule("forge", "gh[pousr]_[A-Za-z0-9]+", 0, 40),
    Rule("cloud", "AIza[0-9A-Za-z_-]+", 0, 39),
    Rule("chat", "xox[abp]-[0-9A-Za-z-]+", 0, 20),
    Rule("private", "-----BEGIN (?:RSA |EC |OPENSSH )?PRIVATE KEY-----"),
)


def postings(docs: DataFrame, grams: list[str], id_col: str = "doc_id") -> DataFrame:
    """The inverted index for the trigrams that the rules ask for: (gram, doc_id), text folded to lower case.

    Only these trigrams can narrow a search, so the index holds no others; each occurs once for a row.
    """
    # A column of its own, as the planner would else fold the text anew for each trigram.
    folded = docs.select(F.col(id_col).alias("doc_id"), F.lower(text_or_empty("text")).alias("folded"))
    found = F.array_compact(F.array(*[F.when(F.contains("folded", F.lit(g)), F.lit(g)) for g in grams]))
    return folded.select("doc_id", F.explode(found).alias("gram"))


def candidates(index: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """Intersect postings: (doc_id, kinds) of documents that hold all trigrams of some alternative of a rule."""
    asked = {r.kind: r.trigram_query() for r in rules}
    at = {g: f"g{i}" for i, g in enumerate(mentioned(rules))}
    held = index.groupBy("doc_id").agg(*[F.max((F.col("gram") == g).cast("int")).alias(c) for g, c in at.items()])
    kinds = []
    for kind, query in asked.items():
        if query:
            alternatives = [reduce(lambda a, b: a & b, [F.col(at[g]) == 1 for g in sorted(alt)]) for alt in sorted(query, key=sorted)]
            kinds.append(F.when(reduce(lambda a, b: a | b, alternatives), F.lit(kind)))
    return held.select("doc_id", F.array_compact(F.array(*kinds)).alias("kinds")).where(F.size("kinds") > 0)


def mentioned(rules: tuple[Rule, ...]) -> list[str]:
    """All trigrams that the rules ask for."""
    return sorted({g for r in rules for alt in r.trigram_query() for g in alt})


SPANS = "array<struct<start:int,rank:int,kind:string,end:int>>"
#: Matches of one step of the two-step sums of positions.
STEP = 256


def matches(text: Column, rule: Rule) -> Column:
    """Array of (gap, size, value): lengths of the text before each match, of the match and of its group `value`; a last entry has no match."""
    regex = F.lit(rule.regex)
    hits = F.regexp_extract_all(text, regex, F.lit(0))
    value = hits if rule.value == 0 else F.regexp_extract_all(text, regex, F.lit(rule.value))
    sizes = lambda a: F.transform(a, lambda x: F.length(x))
    return F.arrays_zip(sizes(F.split(text, rule.regex, -1)).alias("gap"), sizes(hits).alias("size"), sizes(value).alias("value"))


def spans(parts: str, rule: Rule, order: int) -> Column:
    """Array of (start, rank, kind, end) of the rule's matches, leftmost and non-overlapping; code points, end exclusive.

    The text between matches comes from split, the matches from regexp_extract_all; lengths add up to positions, first
    over steps of STEP matches, then inside each, so that a text full of matches is not summed in quadratic time.
    """
    empty = F.array().cast(SPANS)
    size = lambda p: p["gap"] + F.coalesce(p["size"], F.lit(0))
    step = lambda i: F.slice(parts, i * STEP + 1, STEP)
    last = F.ceil(F.size(parts) / STEP).cast("int") - 1
    starts = F.aggregate(
        F.sequence(F.lit(0), last),
        F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("starts")),
        lambda s, i: F.struct(F.aggregate(step(i), s["at"], lambda a, p: a + size(p)).alias("at"), F.array_append(s["starts"], s["at"]).alias("starts")),
        lambda s: s["starts"],
    )

    def walked(start: Column, i: Column) -> Column:
        def move(s: Column, p: Column) -> Column:
            begin = s["at"] + p["gap"]
            span = F.struct(begin.alias("start"), F.lit(order).alias("rank"), F.lit(rule.kind).alias("kind"), (begin + p["size"]).alias("end"))
            return F.struct((s["at"] + size(p)).alias("at"), F.when(p["value"] >= rule.least, F.array_append(s["found"], span)).otherwise(s["found"]).alias("found"))

        return F.aggregate(step(i), F.struct(start.alias("at"), empty.alias("found")), move, lambda s: s["found"])

    return F.coalesce(F.flatten(F.transform(starts, walked)), empty)


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id") -> DataFrame:
    """One row for each document: (doc_id, spans), an array of (start, rank, kind, end) sorted by start, then rule.

    Rules with mandatory trigrams are verified only on candidates of the index; rules without read every text. The
    candidates are written to the shared folder, so the planner knows their size: while small they are broadcast,
    beyond that the join shuffles. Rows of one id share candidates (more are verified, none lost). NULL text is empty;
    NULL ids match each other; an empty table gives no rows; other columns are ignored.
    """
    indexed = [r for r in rules if r.trigram_query()]
    texts = docs.select(F.col(id_col).alias("doc_id"), text_or_empty("text").alias("text"))
    if indexed:
        some = kept_table(candidates(postings(docs, mentioned(rules), id_col), rules))
        texts = texts.alias("d").join(some.alias("c"), F.col("d.doc_id").eqNullSafe(F.col("c.doc_id")), "left").select("d.doc_id", "d.text", "c.kinds")
    parts = []
    for i, r in enumerate(rules):
        here = F.regexp_like("text", F.lit(r.regex))
        parts.append(F.when(F.array_contains("kinds", r.kind) & here if r in indexed else here, matches(F.col("text"), r)).alias(f"parts_{i}"))
    found = [spans(f"parts_{i}", r, i) for i, r in enumerate(rules)]
    return texts.select("doc_id", *parts).select("doc_id", F.array_sort(F.concat(*found)).alias("spans"))


def written(found: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """kind:start:end of each span of the rules, comma-joined."""
    found = F.filter(found, lambda s: s["kind"].isin([r.kind for r in rules]))
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
