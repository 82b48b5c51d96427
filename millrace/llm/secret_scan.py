"""Secret scanning with a trigram inverted index, in DataFrame functions only.

From each rule's expression a Boolean query over trigrams is derived: literal runs must
occur, alternatives are a disjunction. The index holds postings for the trigrams that some
rule needs: (trigram, document) for every document whose folded text contains it. A rule's
candidates come from intersecting postings clause by clause (a disjunction of conjunctions,
counted per document); the expression itself then runs on the whole text of its candidates
only. Rules without a mandatory trigram run on all documents.

Spans come from the pieces between matches: a match begins where the pieces and matches before it end, counted
in code points. Matches are leftmost and do not overlap within a rule; those that fail the
rule's length condition are dropped after matching.

Defined results: a null text is empty and has no spans; rows that repeat a doc_id are scanned
each on their own.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import product
from operator import and_, or_
from re import _constants as sre  # the standard library's own expression tree
from re import _parser as tree

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import given_id, keyed, whole_row

ALTERNATIVES = 64  # literal strings followed at once while a query is derived


@dataclass(frozen=True)
class Rule:
    """A kind of secret: expression, the group whose length counts, its least length."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


# The three base rules.
BASE = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]+", 0, 24),
)
# Published formats of further credentials.
MORE = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("stripe", r"[rs]k_(?:live|test)_[A-Za-z0-9]{16,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+"),
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("url_login", r"://[A-Za-z0-9._-]+:[^\x20\x09-\x0D@/:]+@"),
)
RULES = BASE + MORE


# ---------------------------------------------------------------- trigram queries


def trigram_query(pattern: str) -> list[list[str]] | None:
    """Alternatives (any of) of folded trigrams (all of) that a match must contain; None if a
    match may contain none."""
    best: list[set[str]] | None = None
    for strings in _literal_runs(tree.parse(pattern)):
        parts = [{s[i : i + 3].lower() for i in range(len(s) - 2)} for s in strings]
        if all(parts) and (best is None or min(map(len, parts)) > min(map(len, best))):
            best = parts
    if best is None:
        return None
    clauses = {frozenset(p) for p in best}
    return sorted(sorted(p) for p in clauses if not any(q < p for q in clauses))


def _literal_runs(items) -> list[set[str]]:
    """Sets of strings of which each match contains one, for every stretch of literals."""
    found, now = [], {""}
    for op, value in items:
        exact = _exact(op, value)
        if exact is not None and len(now) * len(exact) <= ALTERNATIVES:
            now = {a + b for a, b in product(now, exact)}
            continue
        found.append(now)
        now = {""} if exact is None else exact
        inner = value[3] if op is sre.SUBPATTERN else value[2] if op is sre.MAX_REPEAT and value[0] else None
        if exact is None and inner is not None:
            found += _literal_runs(inner)
    return [*found, now]


def _exact(op, value) -> set[str] | None:
    """All strings the node matches, if they are few."""
    if op is sre.LITERAL:
        return {chr(value)}
    if op is sre.IN and all(o is sre.LITERAL for o, _ in value):
        return {chr(v) for _, v in value} if len(value) <= 8 else None
    if op is sre.SUBPATTERN:
        return _sequence(value[3])
    if op is sre.BRANCH:
        parts = [_sequence(branch) for branch in value[1]]
        return set().union(*parts) if all(p is not None for p in parts) else None
    if op is sre.MAX_REPEAT and value[1] <= 2:
        once = _sequence(value[2])
        if once is not None:
            return set().union(*({"".join(p) for p in product(once, repeat=k)} for k in range(value[0], value[1] + 1)))
    return None


def _sequence(items) -> set[str] | None:
    out = {""}
    for op, value in items:
        exact = _exact(op, value)
        if exact is None or len(out) * len(exact) > ALTERNATIVES:
            return None
        out = {a + b for a, b in product(out, exact)}
    return out


# ---------------------------------------------------------------- index and search


def postings(rows: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """(trigram, doc, tag) for the trigrams that the rules need."""
    wanted = sorted({t for r in rules for clause in trigram_query(r.pattern) or [] for t in clause})
    low = F.lower("text")
    present = F.array_compact(F.array(*[F.when(F.contains("_low", F.lit(t)), F.lit(t)) for t in wanted]))
    return rows.select("doc", "tag", low.alias("_low")).select("doc", "tag", F.explode(present).alias("trigram"))


def candidates(index: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """(doc, tag, kinds): the rules whose trigram query a document meets."""
    clauses = [(r.kind, i, t) for r in rules for i, clause in enumerate(trigram_query(r.pattern) or []) for t in clause]
    sizes = {(r.kind, i): len(clause) for r in rules for i, clause in enumerate(trigram_query(r.pattern) or [])}
    held = index.groupBy("doc", "tag").agg(F.collect_set("trigram").alias("held"))  # at most the rules' trigrams
    has = lambda kind: reduce(or_, [
        reduce(and_, [F.array_contains("held", t) for k, i, t in clauses if (k, i) == key]) for key in sizes if key[0] == kind])
    kinds = F.array_compact(F.array(*[F.when(has(kind), F.lit(kind)) for kind in sorted({k for k, _ in sizes})]))
    return held.select("doc", "tag", kinds.alias("kinds")).where(F.size("kinds") > 0)


def rule_spans(text: Column, rule: Rule) -> Column:
    """Array of (start, kind, end) of the rule's matches in a text."""
    pattern = F.lit(rule.pattern)
    whole = F.regexp_extract_all(text, pattern, F.lit(0))
    counted = F.regexp_extract_all(text, pattern, F.lit(rule.group)) if rule.group else whole
    pieces = F.split(text, rule.pattern, -1)
    steps = F.zip_with(F.slice(pieces, 1, F.size(whole)), whole, lambda p, m: F.struct(F.length(p).alias("gap"), F.length(m).alias("n")))
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))
    walked = F.aggregate(steps, zero, lambda acc, s: F.struct(
        (acc["at"] + s["gap"] + s["n"]).alias("at"), F.concat(acc["spans"], F.array(F.struct((acc["at"] + s["gap"]).alias("start"), (acc["at"] + s["gap"] + s["n"]).alias("end")))).alias("spans")))["spans"]
    kept = F.filter(F.arrays_zip(walked.alias("span"), counted.alias("m")), lambda x: F.length(x["m"]) >= rule.least)
    return F.transform(kept, lambda x: F.struct(x["span"]["start"].alias("start"), F.lit(rule.kind).alias("kind"), x["span"]["end"].alias("end")))


def _shortened(rule: Rule) -> Rule:
    """A rule of one repeated class finds the same spans when the least length is part of the expression."""
    m = re.fullmatch(r"(\[[^\]]+\])\+", rule.pattern)
    return Rule(rule.kind, f"{m[1]}{{{rule.least},}}") if m and not rule.group else rule


def find_secrets(docs: DataFrame, rules: Sequence[Rule] = RULES, id_col: str = "doc_id", text_col: str = "text", **more: Column) -> DataFrame:
    """Per document: doc_id, text and found, an array of (start, rank, kind, end) by start, then rule order;
    then `more` (name = column of docs)."""
    rows = keyed(docs, id_col, text_col, **more)
    indexed = [r for r in rules if trigram_query(r.pattern)]
    known = candidates(postings(rows, indexed), indexed)
    joined = rows.join(known.hint("shuffle_hash"), ["doc", "tag"], "left")
    none = F.array().cast("array<struct<start:int,kind:string,end:int>>")
    spans = [F.when(F.array_contains("kinds", r.kind), rule_spans(F.col("text"), r)) if r in indexed
             else F.when(F.col("text").rlike(_shortened(r).pattern), rule_spans(F.col("text"), _shortened(r))) for r in rules]
    rank = F.create_map(*[F.lit(x) for i, r in enumerate(rules) for x in (r.kind, i)])
    ordered = F.array_sort(F.transform(F.flatten(F.array(*[F.coalesce(s, none) for s in spans])), lambda x: F.struct(
        x["start"].alias("start"), rank[x["kind"]].alias("rank"), x["kind"].alias("kind"), x["end"].alias("end"))))
    return joined.select(given_id().alias("doc_id"), "text", ordered.alias("found"), *more)


def joined_spans(found: Column, kinds: Sequence[str] | None = None) -> Column:
    """kind:start:end of the spans, comma-joined; of `kinds` only, if given."""
    if kinds:
        found = F.filter(found, lambda x: x["kind"].isin(*kinds))
    return F.array_join(F.transform(found, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def redacted(text: Column, found: Column) -> Column:
    """The text with every span replaced by its kind in brackets; overlapping spans as one."""
    zero = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    cut = lambda a, b: F.substring(text, a + 1, b - a)
    done = F.aggregate(found, zero, lambda acc, s: F.struct(
        F.greatest(acc["at"], s["end"]).alias("at"),
        F.when(s["start"] >= acc["at"], F.concat(acc["out"], cut(acc["at"], s["start"]), F.lit("["), s["kind"], F.lit("]"))).otherwise(acc["out"]).alias("out")))
    return F.when(F.size(found) == 0, text).otherwise(F.concat(done["out"], cut(done["at"], F.length(text))))


def without_secrets(docs: DataFrame, rules: Sequence[Rule] = RULES, id_col: str = "doc_id", text_col: str = "text", chars_col: str = "n_chars") -> DataFrame:
    """`docs` with every secret replaced; a null text stays null, `chars_col` (if there) counts the new text."""
    out = find_secrets(docs, rules, id_col, text_col, row=whole_row(docs))
    text = F.when(F.col(f"row.`{text_col}`").isNotNull(), redacted(F.col("text"), F.col("found")))
    row = F.col("row").withField(f"`{text_col}`", text)
    out = out.select(row.alias("row"), (F.size("found") > 0).alias("changed"))
    if chars_col in docs.columns:
        chars = F.when(F.col("changed"), F.length(f"row.`{text_col}`").cast(docs.schema[chars_col].dataType)).otherwise(F.col(f"row.`{chars_col}`"))
        out = out.select(F.col("row").withField(f"`{chars_col}`", chars).alias("row"))
    return out.select("row.*")


def query(spark, sf_dir: str) -> DataFrame:
    out = find_secrets(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    base = [r.kind for r in BASE]
    count = lambda kind: F.size(F.filter("found", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return out.select("doc_id", *[count(k) for k in base], F.sha2(joined_spans(F.col("found"), base), 256).alias("base_sha256"), joined_spans(F.col("found")).alias("spans"))


def _rule_sql(rank: int, rule: Rule) -> str:
    pattern = rule.pattern.replace("'", "''")
    return f"""SELECT doc_id, {rank} AS rank, '{rule.kind}' AS kind, start, start + length(m) AS stop FROM (
      SELECT doc_id, m, g, list_sum(list_transform(list_slice(ps, 1, k), lambda x: length(x)))::BIGINT + coalesce(list_sum(list_transform(list_slice(ms, 1, k - 1), lambda x: length(x))), 0)::BIGINT AS start
      FROM (SELECT doc_id, ms, ps, unnest(ms) AS m, unnest(gs) AS g, generate_subscripts(ms, 1) AS k FROM (
        SELECT doc_id, regexp_extract_all(text, '{pattern}') AS ms, regexp_extract_all(text, '{pattern}', {rule.group}) AS gs, string_split_regex(text, '{pattern}') AS ps FROM d)))
      WHERE length(g) >= {rule.least}"""


SQL = "WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents), f AS (" + " UNION ALL ".join(_rule_sql(i, r) for i, r in enumerate(RULES)) + """),
s AS (SELECT doc_id, count(*) FILTER (kind = 'assign') AS a, count(*) FILTER (kind = 'access') AS b, count(*) FILTER (kind = 'hex') AS c,
  string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank) FILTER (rank < 3) AS base, string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank) AS spans FROM f GROUP BY 1)
SELECT doc_id, coalesce(a, 0)::BIGINT AS n_assign, coalesce(b, 0)::BIGINT AS n_access, coalesce(c, 0)::BIGINT AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN s USING (doc_id)"""
