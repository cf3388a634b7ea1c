"""Secret scans through a trigram inverted index, in DataFrame functions only.

Each rule's regular expression yields a Boolean trigram query: alternatives of trigram
sets, one of which every matching text must hold. Postings (trigram, text key) of those
trigrams are intersected per alternative; only texts that satisfy one are fetched and
verified with the expression itself. A rule without a mandatory trigram runs on all texts.
Trigrams are taken from lower-cased text, so the index serves rules in either case.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from viewtide.llm.common import whole_text

#: Exact strings that one stretch of an expression may stand for before it is given up as open.
MOST_STRINGS = 64


@dataclass(frozen=True)
class Rule:
    """Spans of ``pattern``; where ``group`` is set, that group must have ``least`` characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0


#: The base kinds, in the order in which they are listed.
BASE_RULES = (
    Rule(
        "assign",
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        group=2,
        least=6,
    ),
    # A run shorter than that has no longer run inside it, so the lengths can stand here.
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]{24,}"),
)

#: Published key formats.
KEY_RULES = (
    Rule("pem", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
    Rule("github", r"gh[opusr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[0-9A-Za-z_-]{35}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
)

Query = frozenset[frozenset[str]]
ANY: Query = frozenset([frozenset()])


def _all_of(queries: Iterable[Query]) -> Query:
    out = ANY
    for query in queries:
        out = _fewest(frozenset(a | b for a, b in itertools.product(out, query)))
    return out


def _fewest(query: Query) -> Query:
    """Without alternatives that another one already covers."""
    return frozenset(a for a in query if not any(b < a for b in query))


def _of_strings(strings: set[str]) -> Query:
    return _fewest(frozenset(frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings))


def _strings_of(op: str, value) -> set[str] | None:
    """The few lower-case strings that one item of an expression stands for; None: too many."""
    if op == "LITERAL":
        return {chr(value).lower()}
    if op == "IN":
        chars: set[str] = set()
        for kind, what in value:
            if str(kind) == "LITERAL":
                chars.add(chr(what).lower())
            elif str(kind) == "RANGE" and what[1] - what[0] < 8:
                chars |= {chr(c).lower() for c in range(what[0], what[1] + 1)}
            else:
                return None
        return chars if len(chars) <= 8 else None
    if op == "SUBPATTERN":
        return _strings_of_all(value[3])
    if op == "BRANCH":
        parts = [_strings_of_all(part) for part in value[1]]
        return None if None in parts else set().union(*parts)
    if op == "MAX_REPEAT" and value[1] <= 4:
        once = _strings_of_all(value[2])
        if once is None:
            return None
        out: set[str] = set()
        for n in range(value[0], value[1] + 1):
            out |= {"".join(x) for x in itertools.product(once, repeat=n)}
        return out if len(out) <= MOST_STRINGS else None
    return None


def _strings_of_all(items) -> set[str] | None:
    out = {""}
    for op, value in items:
        own = _strings_of(str(op), value)
        if own is None or len(out) * len(own) > MOST_STRINGS:
            return None
        out = {a + b for a in out for b in own}
    return out


def _query_of(items) -> Query:
    """All stretches of known strings are mandatory, and so is what open items demand inside."""
    queries, run = [], {""}
    for op, value in items:
        op = str(op)
        own = _strings_of(op, value)
        if own is not None and len(run) * len(own) <= MOST_STRINGS:
            run = {a + b for a in run for b in own}
            continue
        queries.append(_of_strings(run))
        run = {""} if own is None else own
        if own is None and op == "SUBPATTERN":
            queries.append(_query_of(value[3]))
        elif own is None and op == "BRANCH":
            queries.append(_fewest(frozenset().union(*(_query_of(part) for part in value[1]))))
        elif own is None and op == "MAX_REPEAT" and value[0] > 0:
            queries.append(_query_of(value[2]))
    return _all_of([*queries, _of_strings(run)])


def trigram_query(pattern: str) -> Query:
    """Alternatives of trigrams that a matching text holds, lower-cased; :data:`ANY` if none is needed."""
    return _query_of(re._parser.parse(pattern))


def postings(docs: DataFrame, trigrams: Iterable[str]) -> DataFrame:
    """The inverted index: rows (trigram, key) for each wanted trigram that a text holds."""
    lowered = docs.select("key", F.lower("text").alias("lowered"))
    held = [F.when(F.contains("lowered", F.lit(t)), F.lit(t)) for t in sorted(trigrams)]
    return lowered.select(F.explode(F.array_compact(F.array(*held))).alias("trigram"), "key")


def candidates(docs: DataFrame, rules: Iterable[Rule]) -> DataFrame:
    """Rows (key, kinds): the rules whose trigram query a text satisfies, for indexed rules."""
    wanted = []
    for rule in rules:
        for n, trigrams in enumerate(sorted(map(sorted, trigram_query(rule.pattern)))):
            # Asking for fewer only adds candidates; a bit for each must fit a number.
            trigrams = trigrams[:60]
            wanted += [(rule.kind, n, 1 << bit, (1 << len(trigrams)) - 1, t) for bit, t in enumerate(trigrams)]
    # The table of queries has a row for each trigram of each rule.
    quoted = (str((*row[:4], "")).replace("''", "'{}'").format(row[4].replace("'", "\\'")) for row in wanted)
    queries = docs.sparkSession.sql(
        f"SELECT * FROM VALUES {', '.join(quoted)} AS q(kind, alternative, bit, whole, trigram)"
    ).withColumns({name: F.col(name).cast("long") for name in ("bit", "whole")})
    met = (
        postings(docs, {t for *_, t in wanted})
        .join(F.broadcast(queries), "trigram")
        .groupBy("key", "kind", "alternative", "whole")
        .agg(F.bit_or("bit").alias("held"))
        .filter("held = whole")
    )
    return met.groupBy("key").agg(F.collect_set("kind").alias("kinds"))


def _spans(found: str, between: str) -> Column:
    """Start and end of each match, from the matches and the texts around them."""
    return F.expr(
        f"""aggregate(
            sequence(0, size({found}) - 1),
            named_struct('at', 0, 'spans', cast(array() AS array<struct<start: int, stop: int>>)),
            (had, i) -> named_struct(
                'at', had.at + length({between}[i]) + length({found}[i]),
                'spans', concat(had.spans, array(named_struct(
                    'start', had.at + length({between}[i]),
                    'stop', had.at + length({between}[i]) + length({found}[i]))))),
            had -> had.spans)"""
    )


NO_SPANS = "cast(array() AS array<struct<start: int, stop: int>>)"


def find_secrets(docs: DataFrame, rules: Iterable[Rule] = BASE_RULES + KEY_RULES) -> DataFrame:
    """All columns of ``docs`` and ``secrets``: an array of (start, place, stop, kind) in order.

    Places are code points, the end exclusive; ``place`` is the rule's place among the rules.
    A null text has no spans. Each row gives one row; repeated rows and ids, and null ids,
    are looked up by a hash of id and text and verified on their own text. An input column
    named ``secrets`` is replaced.
    """
    rules = list(rules)
    indexed = [rule for rule in rules if trigram_query(rule.pattern) != ANY]
    names = [name for name in docs.columns if name != "secrets"]
    keyed = docs.select(
        F.struct(*(F.col(f"`{name}`") for name in names)).alias("row"),
        whole_text().alias("text"),
        F.xxhash64("doc_id", "text").alias("key"),
    )
    if indexed:
        keyed = keyed.join(candidates(keyed.select("key", "text"), indexed), "key", "left")
    else:
        keyed = keyed.withColumn("kinds", F.lit(None).cast("array<string>"))
    for rule in rules:
        pattern = F.lit(rule.pattern)
        matches = F.regexp_extract_all("text", pattern, F.lit(0))
        if rule in indexed:
            matches = F.when(F.array_contains("kinds", rule.kind), matches)
        keyed = keyed.withColumn(f"found_{rule.kind}", matches)
    for rule in rules:
        some = F.size(f"found_{rule.kind}") > 0
        keyed = keyed.withColumn(f"between_{rule.kind}", F.when(some, F.split("text", rule.pattern, -1)))
        if rule.group:
            part = F.regexp_extract_all("text", F.lit(rule.pattern), F.lit(rule.group))
            keyed = keyed.withColumn(f"part_{rule.kind}", F.when(some, part))
    for rule in rules:
        spans = F.when(F.size(f"found_{rule.kind}") > 0, _spans(f"found_{rule.kind}", f"between_{rule.kind}"))
        keyed = keyed.withColumn(f"spans_{rule.kind}", F.coalesce(spans, F.expr(NO_SPANS)))
    arrays = []
    for place, rule in enumerate(rules):
        kept = f"spans_{rule.kind}"
        if rule.group:
            kept = f"filter({kept}, (s, i) -> length(part_{rule.kind}[i]) >= {rule.least})"
        arrays.append(
            f"transform({kept}, s -> named_struct('start', s.start, 'place', {place}, 'stop', s.stop, 'kind', '{rule.kind}'))"
        )
    found = F.expr(f"array_sort(concat({', '.join(arrays)}))")
    return keyed.select("row", found.alias("secrets")).select("row.*", "secrets")


def written(spans: str) -> Column:
    """The spans as ``kind:start:end``, comma-joined."""
    return F.expr(f"array_join(transform({spans}, s -> concat(s.kind, ':', s.start, ':', s.stop)), ',')")


def digest(found: DataFrame, base: int = len(BASE_RULES)) -> DataFrame:
    """Counts, the hash of the base spans, and all spans."""
    counts = [
        F.size(F.expr(f"filter(secrets, s -> s.kind = '{rule.kind}')")).cast("long").alias(f"n_{rule.kind}")
        for rule in BASE_RULES
    ]
    own = f"filter(secrets, s -> s.place < {base})"
    return found.select("doc_id", *counts, F.sha2(written(own), 256).alias("base_sha256"), written("secrets").alias("spans"))


def redact(found: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """Replace every stretch of overlapping spans in ``text`` by ``mark``; other texts stay."""
    text = F.expr(
        f"""aggregate(
            secrets,
            named_struct('at', 0, 'out', ''),
            (had, s) -> named_struct(
                'at', greatest(had.at, s.stop),
                'out', if(s.start < had.at, had.out,
                          concat(had.out, substring(text, had.at + 1, s.start - had.at), '{mark}'))),
            had -> concat(had.out, substring(text, had.at + 1)))"""
    )
    return found.withColumn("text", F.when(F.size("secrets") > 0, text).otherwise(F.col("text"))).drop("secrets")
