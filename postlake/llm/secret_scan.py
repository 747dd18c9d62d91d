"""Secrets in texts: candidates from a trigram index, then exact matches; DataFrame functions only."""

from __future__ import annotations

import re._constants as kinds_of
import re._parser as regex_parser
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlake.llm.common import stored

_MOST_STRINGS = 64
_MOST_CLASS = 8


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern`` (leftmost, not overlapping) whose ``group`` has ``least`` characters or more."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0


# Fixed patterns and lengths. A run of one class is written with its least length, which finds the same runs.
BASE_RULES = (
    Rule(
        "assign",
        r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        group=2,
        least=12,
    ),
    Rule("access", r"AKIA[A-Z0-9]{14,}", least=18),
    Rule("hex", r"[0-9a-f]{16,}", least=16),
)
MORE_RULES = (
    Rule("private_key", r"-----BEGIN (?:[A-Z]+ )?PRIVATE KEY-----"),
    Rule("github", r"gh[opsu]_[A-Za-z0-9]{36,}"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
)
RULES = BASE_RULES + MORE_RULES


def _strings(items: Iterable) -> set[str] | None:
    """All strings, in lower case, that the items can match, or None if there are many."""
    found = {""}
    for kind, value in items:
        part: set[str] | None
        if kind is kinds_of.LITERAL:
            part = {chr(value).lower()}
        elif kind is kinds_of.IN:
            part = {chr(v).lower() for k, v in value} if all(k is kinds_of.LITERAL for k, _ in value) else None
            part = part if part and len(part) <= _MOST_CLASS else None
        elif kind is kinds_of.SUBPATTERN:
            part = _strings(value[3])
        elif kind is kinds_of.BRANCH:
            options = [_strings(option) for option in value[1]]
            part = None if None in options else set().union(*options)
        elif kind is kinds_of.MAX_REPEAT and value[1] == value[0]:
            one = _strings(value[2])
            part = None if one is None or value[0] > 32 else {"".join(x) for x in product(one, repeat=value[0])}
        elif kind is kinds_of.MAX_REPEAT and value[:2] == (0, 1):
            one = _strings(value[2])
            part = None if one is None else one | {""}
        else:
            part = None
        if part is None or len(found) * len(part) > _MOST_STRINGS:
            return None
        found = {a + b for a in found for b in part}
    return found


def _options(strings: set[str]) -> list[frozenset[str]]:
    """The trigrams of each string, without options that another one implies; none if a string has no trigram."""
    sets = {frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings}
    if frozenset() in sets:
        return []
    return sorted((s for s in sets if not any(o < s for o in sets)), key=sorted)


def trigram_query(pattern: str) -> list[list[frozenset[str]]]:
    """A condition on lower-case trigrams that every match implies: all terms, of each one option, of it all trigrams.

    Consecutive parts of the pattern that can match few strings are taken together; each such stretch is
    a term. The empty list says that no trigram is mandatory.
    """
    terms, stretch = [], []

    def close() -> None:
        options = _options(_strings(stretch) or {""})
        if options:
            terms.append(options)
        stretch.clear()

    def walk(items: Iterable) -> None:
        for kind, value in items:
            if _strings([*stretch, (kind, value)]) is not None:
                stretch.append((kind, value))
                continue
            close()
            if kind is kinds_of.SUBPATTERN:
                walk(value[3])
                close()
            elif kind is kinds_of.MAX_REPEAT and value[0] > 0:
                walk(value[2])
                close()
            elif _strings([(kind, value)]) is not None:
                stretch.append((kind, value))

    walk(regex_parser.parse(pattern))
    close()
    return terms


def build_index(docs: DataFrame, trigrams: Sequence[str]) -> DataFrame:
    """Postings ``(trigram, text_key)``: which texts hold which of ``trigrams``, case aside.

    The key is a hash of the text, so copies share postings; texts whose keys collide are candidates
    together and verified apart.
    """
    held = F.filter(F.array(*map(F.lit, trigrams)), lambda t: F.contains(F.col("_lower"), t))
    texts = docs.select(_text_key().alias("text_key"), F.lower(_text()).alias("_lower"))
    return texts.select("text_key", F.explode(held).alias("trigram"))


def candidates(postings: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """``(text_key, kinds)``: the texts whose postings meet the condition of a rule, for rules that have one.

    A text's postings meet on its key; there is one per trigram at most after the partial aggregation.
    """
    conditions = {}
    for rule in rules:
        terms = trigram_query(rule.pattern)
        if terms:
            holds = lambda t: F.array_contains("_held", t)
            every = lambda option: reduce(Column.__and__, map(holds, sorted(option)))
            conditions[rule.kind] = reduce(Column.__and__, [reduce(Column.__or__, map(every, o)) for o in terms])
    texts = postings.groupBy("text_key").agg(F.collect_set("trigram").alias("_held"))
    kinds = F.array_compact(F.array(*[F.when(met, F.lit(kind)) for kind, met in conditions.items()]))
    return texts.select("text_key", kinds.alias("kinds")).filter(F.size("kinds") > 0)


def _text() -> Column:
    return F.coalesce("text", F.lit(""))


def _text_key() -> Column:
    return F.xxhash64(_text())


def _spans(text: Column, rule: Rule, place: int) -> Column:
    """``array<struct<start, place, end>>`` of a rule's matches in code points, ``end`` exclusive.

    The text is cut at the matches; what lies between them and their own lengths add up to places.
    """
    pattern = F.lit(rule.pattern)
    between = F.transform(F.split(text, rule.pattern, -1), F.length)
    lengths = F.transform(F.regexp_extract_all(text, pattern, F.lit(0)), F.length)
    measured = F.transform(F.regexp_extract_all(text, pattern, F.lit(rule.group)), F.length)
    steps = F.arrays_zip(between.alias("gap"), lengths.alias("size"), measured.alias("measured"))
    kind = "array<struct<start:int,place:int,end:int>>"
    begin = F.struct(F.lit(0).alias("at"), F.array().cast(kind).alias("spans"))

    def step(state: Column, row: Column) -> Column:
        start = state["at"] + row["gap"]
        end = start + F.coalesce(row["size"], F.lit(0))
        span = F.struct(start.alias("start"), F.lit(place).alias("place"), end.alias("end"))
        kept = F.coalesce(row["measured"] >= rule.least, F.lit(False))
        spans = F.when(kept, F.concat(state["spans"], F.array(span))).otherwise(state["spans"])
        return F.struct(end.alias("at"), spans.alias("spans"))

    return F.aggregate(steps, begin, step, lambda state: state["spans"])


def find_secrets(docs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """``(row, spans)`` of every row: its columns as a struct and the sorted ``(start, place, end)`` of secrets.

    ``place`` is that of the rule in ``rules``. Rules with mandatory trigrams look only at texts whose
    postings meet their condition; the others scan every text. A null text is empty and has no spans;
    ids play no part, so null and repeated ones, and repeated rows, are scanned like others; names of
    other columns do not matter; an empty table gives no rows.
    """
    trigrams = sorted({t for r in rules for term in trigram_query(r.pattern) for option in term for t in option})
    boxed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), _text_key().alias("text_key"))
    if trigrams:
        postings = stored(build_index(docs, trigrams), "trigram-index")
        found = stored(candidates(postings, rules), "secret-candidates")
        boxed = boxed.join(found, "text_key", "left")
    else:
        boxed = boxed.withColumn("kinds", F.lit(None).cast("array<string>"))
    text = F.coalesce(F.col("row").getField("text"), F.lit(""))
    none = F.array().cast("array<struct<start:int,place:int,end:int>>")
    parts = []
    for place, rule in enumerate(rules):
        indexed = bool(trigram_query(rule.pattern))
        look = F.coalesce(F.array_contains("kinds", rule.kind), F.lit(False)) if indexed else F.lit(True)
        parts.append(F.when(look & text.rlike(rule.pattern), _spans(text, rule, place)).otherwise(none))
    return boxed.select("row", F.array_sort(F.concat(*parts)).alias("spans"))


def span_text(spans: Column, rules: Sequence[Rule]) -> Column:
    """``kind:start:end`` of the spans, comma-joined."""
    names = F.array(*[F.lit(r.kind) for r in rules])
    one = lambda s: F.concat_ws(":", F.get(names, s["place"]), s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")


def count_of(spans: Column, place: int) -> Column:
    return F.size(F.filter(spans, lambda s: s["place"] == place)).cast("bigint")


def redacted(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """The text with each span, or stretch of overlapping ones, replaced by ``mark``."""
    begin = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(state: Column, span: Column) -> Column:
        gap = F.substring(text, state["at"] + 1, span["start"] - state["at"])
        fresh = (span["start"] >= state["at"]) & (span["end"] > state["at"])
        out = F.when(fresh, F.concat(state["out"], gap, F.lit(mark))).otherwise(state["out"])
        return F.struct(F.greatest(state["at"], span["end"]).alias("at"), out.alias("out"))

    rest = lambda state: F.concat(state["out"], F.substring(text, state["at"] + 1, F.length(text)))
    return F.aggregate(spans, begin, step, rest)


def without_secrets(docs: DataFrame, rules: Sequence[Rule] = RULES, mark: str = "[SECRET]") -> DataFrame:
    """``(row, text, n_secrets)``: rows as a struct, and their text with all secrets replaced."""
    found = find_secrets(docs, rules)
    text = F.col("row").getField("text")
    clean = F.when(F.size("spans") > 0, redacted(text, F.col("spans"), mark)).otherwise(text)
    return found.select("row", clean.alias("text"), F.size("spans").alias("n_secrets"))
