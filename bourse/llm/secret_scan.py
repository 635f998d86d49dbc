"""Secret scans through a trigram inverted index, in DataFrame functions only.

From each rule's regular expression a Boolean query over trigrams is derived: an
OR of ANDs of trigrams that every match must contain.  The index holds one
posting (trigram, row) per row and trigram that some query asks for; a rule's
candidates are the rows whose postings hold all trigrams of one of its ANDs.
The regular expression is then run on candidates alone.  A rule without
mandatory trigrams is run on every row.

The index is over texts with A-Z lower-cased and so are the queries; this can
only add candidates.
"""

from __future__ import annotations

import itertools
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bourse.llm.common import ascii_lower, broadcast_if_small, let, row_key

BROADCAST_ROWS = 200_000
MOST_STRINGS = 128  # literal alternatives kept apart while a query is derived


@dataclass(frozen=True)
class Rule:
    """``kind`` and a pattern; a match counts if its ``group`` has ``least`` characters or more."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    base: bool = False


# Base rules first, in the order that sorts spans with equal starts.  The others are public token formats.
# Runs of one character class are matched whole, so a least length may stand in the pattern.
RULES = (
    Rule("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 6, True),
    Rule("access", r"AKIA[A-Z0-9]{16,}", base=True),
    Rule("hex", r"[0-9a-f]{24,}", base=True),
    Rule("private_key", r"-----BEGIN\x20[A-Z\x20]*PRIVATE\x20KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[0-9A-Za-z_-]{35}"),
    Rule("stripe", r"[rs]k_live_[0-9A-Za-z]{16,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}[.]eyJ[A-Za-z0-9_-]{8,}[.][A-Za-z0-9_-]{8,}"),
)


# --- Boolean trigram queries ---------------------------------------------------------------------

ANY = frozenset({frozenset()})  # an OR of one AND of nothing: always true


def _least(dnf: set) -> frozenset:
    """Without the ANDs that another one implies."""
    return frozenset(a for a in dnf if not any(b < a for b in dnf))


def _and(x: frozenset, y: frozenset) -> frozenset:
    both = _least({a | b for a in x for b in y})
    return both if len(both) <= MOST_STRINGS else x  # a weaker query is still a true one


def _of_strings(strings: set[str]) -> frozenset:
    return _least({frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings})


def _read(node) -> tuple[set[str] | None, frozenset]:
    """Of a parsed pattern: all its strings if they are few, and what every match must contain."""
    strings, need, whole = {""}, ANY, True
    for kind, arg in node:
        kind, own, query = str(kind), None, ANY
        if kind == "LITERAL":
            own = {chr(arg).lower()}
        elif kind == "IN" and all(str(k) in ("LITERAL", "RANGE") for k, _ in arg):
            chars = {c for k, v in arg for c in ([v] if str(k) == "LITERAL" else range(v[0], v[1] + 1))}
            own = {chr(c).lower() for c in chars} if len(chars) <= 8 else None
        elif kind == "SUBPATTERN":
            own, query = _read(arg[3])
        elif kind == "BRANCH":
            parts = [_read(x) for x in arg[1]]
            if all(p[0] is not None for p in parts):
                own = set().union(*(p[0] for p in parts))
            else:
                query = _least(set().union(*(p[1] if p[0] is None else _of_strings(p[0]) for p in parts)))
        elif kind in ("MAX_REPEAT", "MIN_REPEAT"):
            low, high, inner = arg
            some, asked = _read(inner)
            if some is not None and high <= 4 and len(some) ** int(high) <= MOST_STRINGS:
                own = {"".join(x) for n in range(low, int(high) + 1) for x in itertools.product(sorted(some), repeat=n)}
            elif low:
                query = asked if some is None else _of_strings(some)
        if own is not None and len(strings) * len(own) <= MOST_STRINGS:
            strings = {a + b for a in strings for b in own}
            continue
        # what has run together so far ends here
        whole = False
        need = _and(_and(need, _of_strings(strings)), query if own is None else _of_strings(own))
        strings = {""}
    return (strings, _of_strings(strings)) if whole else (None, _and(need, _of_strings(strings)))


def trigram_query(pattern: str) -> frozenset:
    """The OR of ANDs of trigrams (lower case) that every match of a pattern contains; ``ANY`` if there is none."""
    from re import _parser  # the standard library's own parser of patterns

    return _read(_parser.parse(pattern))[1]


# --- the index -----------------------------------------------------------------------------------


def postings(rows: DataFrame, trigrams: list[str]) -> DataFrame:
    """``key, trigram``: the postings of the given trigrams over ``rows`` (columns key, t)."""
    asked = F.array(*(F.lit(t) for t in trigrams)).cast("array<string>")
    held = let(ascii_lower(F.col("t")), lambda text: F.filter(asked, lambda t: F.contains(text, t)))
    return rows.select("key", F.explode(held).alias("trigram"))


def candidates(rows: DataFrame, rules: tuple[Rule, ...]) -> tuple[DataFrame, list[str]]:
    """``key, kinds`` of the rows that rules' trigram queries leave, and the kinds that must scan every row."""
    queries = {r.kind: trigram_query(r.pattern) for r in rules}
    scan = [k for k, q in queries.items() if q == ANY]
    terms = [
        (kind, f"{kind}:{n}", t, 1 << j, (1 << len(conj)) - 1)
        for kind, q in queries.items() if q != ANY
        for n, conj in enumerate(sorted(map(sorted, q)))
        for j, t in enumerate(conj)
    ]
    spark = rows.sparkSession
    if not terms:
        return rows.select("key", F.array().cast("array<string>").alias("kinds")).where("false"), scan
    asked = spark.createDataFrame(terms, "kind string, conj string, trigram string, bit long, full long")
    # the terms are as many as the rules ask for, whatever the corpus
    found = postings(rows, sorted({t[2] for t in terms})).join(F.broadcast(asked), "trigram")
    met = found.groupBy("key", "kind", "conj", "full").agg(F.bit_or("bit").alias("bits")).where("bits = full")
    return met.groupBy("key").agg(F.collect_set("kind").alias("kinds")), scan


# --- spans ---------------------------------------------------------------------------------------


def running_sums(numbers: Column) -> Column:
    """Per element the sum of an integer array up to and including it.

    A list that grows by one element is copied at every step, so the array is cut into pieces of about the
    square root of its size, summed piece by piece, and each piece is raised by the sum of those before it.
    """

    def grow(sums: Column, v: Column) -> Column:
        return F.concat(sums, F.array(F.element_at(sums, -1) + v))

    def summed(x: Column) -> Column:
        return F.aggregate(x, F.array(F.lit(0)), grow)  # a zero first

    def cut(x: Column) -> Column:
        size = F.ceil(F.sqrt(F.size(x))).cast("int")
        return F.when(
            F.size(x) > 0,
            let(size, lambda n: F.transform(F.sequence(F.lit(1), F.size(x), n), lambda at: summed(F.slice(x, at, n)))),
        ).otherwise(F.array().cast("array<array<int>>"))

    def raised(pieces: Column) -> Column:
        before = summed(F.transform(pieces, lambda p: F.element_at(p, -1)))
        whole = let(
            before,
            lambda b: F.transform(pieces, lambda p, i: F.transform(F.slice(p, 2, F.size(p) - 1), lambda v: v + F.get(b, i))),
        )
        return F.flatten(whole)

    return let(let(numbers, cut), raised)


def _spans(text: Column, rule: Rule, order: int) -> Column:
    """The counted matches of a rule as structs (start, order, end) in code points.

    Matches and the pieces between them alternate, so places are running sums of lengths.
    """
    pattern = F.lit(rule.pattern)

    def lengths(strings: Column) -> Column:
        return F.transform(strings, lambda s: F.length(s))

    def place(x: Column) -> Column:
        steps = F.transform(
            x["matches"],
            lambda m, i: F.get(x["pieces"], i) + F.when(i > 0, F.get(x["matches"], i - 1)).otherwise(F.lit(0)),
        )

        def one(start: Column, i: Column) -> Column:
            m = F.get(x["matches"], i)
            size = F.get(x["values"], i) if rule.group else m
            return F.struct(start.alias("start"), F.lit(order).alias("order"), (start + m).alias("end"), size.alias("size"))

        kept = F.filter(F.transform(running_sums(steps), one), lambda s: s["size"] >= rule.least)
        return F.transform(kept, lambda s: F.struct(s["start"].alias("start"), s["order"].alias("order"), s["end"].alias("end")))

    parts = [lengths(F.regexp_extract_all(text, pattern, F.lit(0))).alias("matches"), lengths(F.split(text, rule.pattern, -1)).alias("pieces")]
    if rule.group:
        parts.append(lengths(F.regexp_extract_all(text, pattern, F.lit(rule.group))).alias("values"))
    return let(F.struct(*parts), place)


NO_SPANS = "array<struct<start:int,order:int,end:int>>"


def scan_secrets(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    rules: tuple[Rule, ...] = RULES,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """``doc_id`` and ``found``, the sorted spans (start, order, end) of all rules, per row.

    ``order`` is the rule's place in ``rules``; places are code points, end
    exclusive.  Matches of a rule are leftmost and do not overlap.  Null and
    empty texts have no spans; repeated rows give their spans each; other
    columns are not read.
    """
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("t"), row_key(id_col, text_col).alias("key")
    )
    left, scan = candidates(rows, rules)
    joined = rows.join(broadcast_if_small(left.checkpoint(), broadcast_rows), "key", "left")
    none = F.array().cast(NO_SPANS)
    spans = []
    for order, rule in enumerate(rules):
        if rule.kind in scan:
            test = F.col("t").rlike(rule.pattern)
        else:
            test = F.array_contains(F.coalesce("kinds", F.array().cast("array<string>")), rule.kind)
        spans.append(F.when(test, _spans(F.col("t"), rule, order)).otherwise(none))
    return joined.select("doc_id", F.array_sort(F.flatten(F.array(*spans))).alias("found"))


def span_text(found: Column, rules: tuple[Rule, ...]) -> Column:
    kinds = F.array(*(F.lit(r.kind) for r in rules))
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", F.get(kinds, s["order"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def digest(found: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Counts, the hash of the base rules' spans, and all spans as text."""
    base = [i for i, r in enumerate(rules) if r.base]

    def number(kind: str) -> Column:
        order = [r.kind for r in rules].index(kind)
        return F.size(F.filter("found", lambda s: s["order"] == order)).cast("long").alias("n_" + kind)

    own = F.filter("found", lambda s: s["order"].isin(base))
    return found.select(
        "doc_id",
        *(number(r.kind) for r in rules if r.base),
        F.sha2(span_text(own, rules), 256).alias("base_sha256"),
        span_text(F.col("found"), rules).alias("spans"),
    )


def oracle(rules: tuple[Rule, ...] = RULES) -> str:
    """``digest`` of ``scan_secrets`` over ``documents`` as DuckDB SQL, by running every rule on every text."""

    def ascii_case(pattern: str) -> str:
        # (?i:...) spelled out for ASCII letters, as DuckDB's folds others in
        return re.sub(
            r"\(\?i:([^)]*)\)", lambda m: "(?:" + re.sub("[a-z]", lambda c: f"[{c[0]}{c[0].upper()}]", m[1]) + ")", pattern
        )

    lists = []
    for order, r in enumerate(rules):
        p = ascii_case(r.pattern).replace("'", "''")
        lists.append(f"""
  list_filter(list_transform(range(1, len(regexp_extract_all(t, '{p}')) + 1), lambda i: {{
    'start': list_sum(list_transform(string_split_regex(t, '{p}')[1:i], lambda s: length(s)))
      + coalesce(list_sum(list_transform(regexp_extract_all(t, '{p}')[1:i-1], lambda s: length(s))), 0),
    'ord': {order}, 'len': length(regexp_extract_all(t, '{p}')[i]),
    'size': length(regexp_extract_all(t, '{p}', {r.group})[i])}}), lambda x: x.size >= {r.least})""")
    kinds = ", ".join(f"'{r.kind}'" for r in rules)
    base = [i for i, r in enumerate(rules) if r.base]
    text = f"[{kinds}][x.ord + 1] || ':' || CAST(x.start AS VARCHAR) || ':' || CAST(x.start + x.len AS VARCHAR)"
    counts = ", ".join(
        f"CAST(len(list_filter(f, lambda x: x.ord = {i})) AS BIGINT) AS n_{r.kind}" for i, r in enumerate(rules) if r.base
    )
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
s AS (SELECT doc_id, list_sort(flatten([{",".join(lists)}])) AS f FROM d)
SELECT doc_id, {counts},
  sha256(array_to_string(list_transform(list_filter(f, lambda x: x.ord IN {tuple(base)}), lambda x: {text}), ',')) AS base_sha256,
  array_to_string(list_transform(f, lambda x: {text}), ',') AS spans
FROM s"""
