"""Secret scans over a trigram inverted index.

From each rule's regular expression a Boolean query over trigrams is derived: an AND of
segments, a segment being an OR of literal alternatives, an alternative an AND of its
trigrams. Texts post the rule trigrams they contain; the postings of a text are intersected
and each rule verifies only the texts that satisfy its query. A rule without a mandatory
trigram is verified on every text. All steps are built-in functions.
"""

from __future__ import annotations

from dataclasses import dataclass
from re import _constants as sre
from re import _parser as sre_parse

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigilmart.sources.workspace import settle


@dataclass(frozen=True)
class Rule:
    """``regex`` finds; matches whose ``group`` has under ``least`` characters are dropped."""

    kind: str
    regex: str
    group: int = 0
    least: int = 1


# The base rules, in the order of their kinds, then the added ones.
RULES = (
    Rule(
        "assign",
        r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        8,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 16),
    Rule("hex", r"[0-9a-f]{32,}", 0, 32),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 1),
    Rule("github", r"gh[opsu]_[A-Za-z0-9]{36,}", 0, 40),
)
BASE = ("assign", "access", "hex")

_SPANS = "array<struct<start:bigint,place:int,end:bigint,kind:string>>"
Query = list[list[frozenset[str]]]
_MOST_ALTERNATIVES = 64  # beyond that a segment ends and the next begins; the query only gets weaker


def _trigrams(word: str) -> frozenset[str]:
    return frozenset(word[i : i + 3] for i in range(len(word) - 2))


def trigram_query(regex: str) -> Query:
    """The segments that every match satisfies; empty where no trigram is mandatory."""
    segments: list[set[str]] = []

    def close(words: set[str]) -> set[str]:
        if all(len(w) >= 3 for w in words):
            segments.append(words)
        return {""}

    def walk(tokens, words: set[str]) -> set[str]:
        for kind, value in tokens:
            options: set[str] | None = None
            if kind is sre.LITERAL:
                options = {chr(value).lower()}
            elif kind is sre.IN and all(k is sre.LITERAL for k, _ in value):
                options = {chr(c).lower() for _, c in value}
            elif kind is sre.SUBPATTERN:
                options = fixed(value[-1])
                if options is None:
                    words = walk(value[-1], words)
                    continue
            elif kind is sre.BRANCH:
                options = fixed([(kind, value)])
            elif kind is sre.MAX_REPEAT and value[1] == 1:
                inner = fixed(value[2])
                options = None if inner is None else inner | ({""} if value[0] == 0 else set())
            if options is None or len(words) * len(options) > _MOST_ALTERNATIVES:
                words = close(words)
                options = options if options and len(options) <= _MOST_ALTERNATIVES else {""}
            words = {w + o for w in words for o in options}
        return words

    def fixed(tokens) -> set[str] | None:
        """All strings that the tokens match, lower-cased; None if they aren't few."""
        words = {""}
        for kind, value in tokens:
            if kind is sre.LITERAL:
                options = {chr(value).lower()}
            elif kind is sre.IN and all(k is sre.LITERAL for k, _ in value):
                options = {chr(c).lower() for _, c in value}
            elif kind is sre.SUBPATTERN:
                options = fixed(value[-1])
            elif kind is sre.BRANCH:
                parts = [fixed(p) for p in value[1]]
                options = None if any(p is None for p in parts) else set().union(*parts)
            elif kind is sre.MAX_REPEAT and value[1] == 1:
                inner = fixed(value[2])
                options = None if inner is None else inner | ({""} if value[0] == 0 else set())
            else:
                options = None
            if options is None or len(words) * len(options) > _MOST_ALTERNATIVES:
                return None
            words = {w + o for w in words for o in options}
        return words

    close(walk(sre_parse.parse(regex), {""}))
    return [_least([_trigrams(w) for w in sorted(s)]) for s in segments]


def _least(segment: list[frozenset[str]]) -> list[frozenset[str]]:
    """Drop alternatives that ask for all of another's trigrams and more."""
    return [a for i, a in enumerate(segment) if not any(b < a or (b == a and j < i) for j, b in enumerate(segment))]


def text_key(text: Column) -> Column:
    return F.md5(text)


def postings(docs: DataFrame, text: str, rules=RULES) -> DataFrame:
    """The inverted index: ``gram`` and ``key`` (digest of a text), for trigrams of rules."""
    grams = sorted({g for r in rules for s in trigram_query(r.regex) for a in s for g in a})
    folded = F.lower(F.col(text))
    found = F.filter(F.array(*[F.lit(g) for g in grams]), lambda g: F.contains(F.col("_folded"), g))
    return (
        docs.where(F.col(text).isNotNull())
        .select(text_key(F.col(text)).alias("key"), folded.alias("_folded"))
        .select("key", F.explode(found).alias("gram"))
    )


def candidates(index: DataFrame, rules=RULES) -> DataFrame:
    """Intersect postings: for each ``key`` the kinds of the rules whose query it satisfies."""

    def satisfies(query: Query) -> Column:
        met = F.lit(True)
        for segment in query:
            one = F.lit(False)
            for alternative in segment:
                listed = F.array(*[F.lit(g) for g in sorted(alternative)])
                one = one | (F.size(F.array_except(listed, F.col("grams"))) == 0)
            met = met & one
        return met

    queries = [(r.kind, trigram_query(r.regex)) for r in rules]
    kinds = F.array(*[F.when(satisfies(q), F.lit(k)) for k, q in queries if q])
    return (
        index.groupBy("key")
        .agg(F.collect_set("gram").alias("grams"))
        .select("key", F.filter(kinds, lambda k: k.isNotNull()).alias("kinds"))
        .where(F.size("kinds") > 0)
    )


def matches(text: Column, rule: Rule, place: int) -> Column:
    """Spans of a rule's matches, in code points, found left to right without overlap.

    The text between matches comes from ``split`` and the matches from ``regexp_extract_all``;
    their lengths add up to positions.
    """
    pattern = F.lit(rule.regex)
    parts = F.struct(
        F.transform(F.split(text, rule.regex, -1), lambda x: F.length(x)).alias("gaps"),
        F.transform(F.regexp_extract_all(text, pattern, F.lit(0)), lambda x: F.length(x)).alias("hits"),
        F.transform(F.regexp_extract_all(text, pattern, F.lit(rule.group)), lambda x: F.length(x)).alias("values"),
    )
    empty = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast(_SPANS).alias("spans"))

    def step(state: Column, x: Column) -> Column:
        start = state["at"] + x["gaps"]
        end = (start + x["hits"]).cast("bigint")
        span = F.struct(
            start.cast("bigint").alias("start"), F.lit(place).alias("place"), end.alias("end"), F.lit(rule.kind).alias("kind")
        )
        spans = F.when(x["values"] >= rule.least, F.concat(state["spans"], F.array(span))).otherwise(state["spans"])
        return F.struct(end.alias("at"), spans.alias("spans"))

    def walked(p: Column) -> Column:
        hits = F.slice(p["gaps"], 1, F.size(p["hits"]))
        zipped = F.zip_with(
            F.arrays_zip(hits.alias("gaps"), p["hits"].alias("hits")),
            p["values"],
            lambda a, b: F.struct(a["gaps"].alias("gaps"), a["hits"].alias("hits"), b.alias("values")),
        )
        return F.aggregate(zipped, empty, step)["spans"]

    return F.element_at(F.transform(F.array(parts), walked), 1)


def scan(docs: DataFrame, text: str = "text", rules=RULES) -> DataFrame:
    """Add ``spans`` to every row: start, place of the kind, end and kind, in this order.

    NULL and empty texts have no spans. Equal texts post once, however many rows hold them.
    A column of ``docs`` named ``spans`` is replaced.
    """
    # Written, so that Spark joins by its true size, and can split the rows of a frequent text.
    found = settle(candidates(postings(docs, text, rules), rules), "candidates")
    kept = docs.drop("spans")
    keyed = kept.withColumn("_key", F.coalesce(text_key(F.col(text)), F.lit("")))
    joined = keyed.join(found.select(F.col("key").alias("_key"), F.col("kinds").alias("_kinds")), "_key", "left")
    none = F.array().cast(_SPANS)
    each = []
    for place, rule in enumerate(rules):
        spans = matches(F.col(text), rule, place)
        if trigram_query(rule.regex):
            asked = F.array_contains("_kinds", rule.kind)
        else:
            asked = F.regexp_like(F.col(text), F.lit(rule.regex))
        each.append(F.coalesce(F.when(asked, spans), none))
    return joined.select(*kept.columns, F.sort_array(F.concat(*each)).alias("spans"))


def listed(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    return F.concat_ws(
        ",",
        F.transform(
            spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
        ),
    )


def redacted(text: Column, spans: Column) -> Column:
    """The text with each span, or run of overlapping spans, replaced by ``[secret]``."""
    state = F.struct(F.lit("").alias("out"), F.lit(0).cast("bigint").alias("at"))

    def step(s: Column, x: Column) -> Column:
        gap = F.substr(text, (s["at"] + 1).cast("int"), F.greatest(x["start"] - s["at"], F.lit(0)).cast("int"))
        fresh = (x["start"] >= s["at"]) & (x["end"] > s["at"])
        return F.struct(
            F.when(fresh, F.concat(s["out"], gap, F.lit("[secret]"))).otherwise(s["out"]).alias("out"),
            F.greatest(s["at"], x["end"]).alias("at"),
        )

    walked = F.aggregate(spans, state, step)
    return F.when(F.size(spans) > 0, F.concat(walked["out"], F.substr(text, (walked["at"] + 1).cast("int")))).otherwise(text)
