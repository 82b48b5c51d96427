"""Document analytics: sentiment, entities, key phrases and reports over a table
of (doc_id, text). Whole texts are analysed; heavy steps are counts per document
and term, combined map-side before they are shuffled."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, IDF, IndexToString, StringIndexer
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from millrace.functions import text as tx
from millrace.functions.numeric import safe_ratio
from millrace.operators import blocks, stats
from millrace.operators.relational import BROADCAST_ROWS, fits_broadcast, lookup_join
from millrace.session import written

# Rows up to which labels are broadcast: two numbers each.
LABEL_ROWS = 2_000_000

# Characters up to which a common term is broadcast.
COMMON_LENGTH = 64

# Characters of all texts up to which phrases are counted by their text.
PLAIN_CHARACTERS = 1_000_000

# Labels in the order that decides ties.
SENTIMENTS = ("POSITIVE", "NEGATIVE", "NEUTRAL", "MIXED")

# Fixed values: (type, pattern, score, literal) of the built-in entity finder. Every
# match contains the literal: a text without it is not searched. The match is
# group 1; a leading character class stands for a word boundary, because engines
# differ on what `\b` means next to accented letters.
_EDGE = r"(?:^|[^\p{L}\p{N}])"
ENTITY_PATTERNS = (
    ("DATE", _EDGE + r"([0-9]{4}-[0-9]{2}-[0-9]{2})", 0.99, "-"),
    ("DATE", _EDGE + r"((?:January|February|March|April|May|June|July|August|September|October|November|December) [0-9]{1,2}(?:, [0-9]{4})?)", 0.95, " "),
    ("LOCATION", _EDGE + r"((?:[0-9]{1,3}\.){3}[0-9]{1,3})", 0.6, "."),
    ("OTHER", _EDGE + r"([A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,})", 0.98, "@"),
    ("OTHER", _EDGE + r"(https?://[^ \t\r\n]+)", 0.97, "://"),
    ("PERSON", _EDGE + r"((?:Mr|Mrs|Ms|Dr)\. \p{Lu}\p{Ll}+)", 0.9, ". "),
    ("PERSON", _EDGE + r"(\p{Lu}\p{Ll}+ \p{Lu}\p{Ll}+)", 0.7, " "),
    ("QUANTITY", r"(\$[0-9]+(?:,[0-9]{3})*(?:\.[0-9]+)?)", 0.95, "$"),
    ("QUANTITY", _EDGE + r"([0-9]+(?:\.[0-9]+)?%)", 0.95, "%"),
    ("QUANTITY", _EDGE + r"([0-9]+)", 0.5, ""),
)


# ------------------------------------------------------------ statistics


def text_stats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Characters and blank-separated words per document."""
    t = F.col(text)
    return docs.select(doc_id, F.length(t).alias("text_length"), tx.word_count(t).alias("word_count"))


def pieces(docs: DataFrame, size: int = 5000, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, piece, text): the whole text in pieces a limited scorer accepts."""
    return docs.select(doc_id, F.posexplode(tx.segments(F.col(text), size)).alias("piece", "text"))


def item_counts(docs: DataFrame, items: Column, name: str, doc_id: str = "doc_id", place: Sequence[str] = ()) -> DataFrame:
    """(doc_id, <name>, n): how often each item of an array occurs in its document,
    counted within the row; `place` names a further column, the place of the item among those of its row."""
    listed = docs.select(doc_id, F.sort_array(items).alias("_items"))
    counted = listed.select(doc_id, F.posexplode(tx.runs("_items")).alias("_at", "_r"))
    return counted.select(doc_id, F.col("_r.item").alias(name), F.col("_r.n").alias("n"), *[F.col("_at").alias(p) for p in place])


def term_counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, term, n)."""
    return item_counts(docs, tx.terms(F.col(text)), "term", doc_id)


def processing_status(docs: DataFrame, key: Column, text: Column, min_chars: int = 10) -> DataFrame:
    """Adds `status`: one bad document never stops the others. Non-text files go
    to `unsupported` (no character recognition is built)."""
    suffix = tx.extension(key)
    status = (
        F.when(suffix.isNotNull() & (suffix != "txt"), "unsupported")
        .when(text.isNull() | (F.length(F.trim(text)) < min_chars), "failed")
        .otherwise("processed")
    )
    return docs.withColumn("status", status)


# ------------------------------------------------- personal data, language, category


# Fixed values: (type, pattern) of personal data, in the order they are replaced.
PERSONAL = (
    ("EMAIL", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"),
    ("PHONE", r"\+[0-9]{1,3} ?\([0-9]{3}\) ?[0-9]{3}-[0-9]{4}"),
    ("ADDRESS", r"(?:[0-9]{1,3}\.){3}[0-9]{1,3}"),
    ("NUMBER", r"[0-9]{9,}"),
)


def redact_personal(docs: DataFrame, text: str = "text", patterns: Sequence[tuple[str, str]] = PERSONAL) -> DataFrame:
    """Every find replaced by its type in brackets, and `n_<type>` with the number of finds. A type is
    looked for in what the types before it have left."""
    for kind, pattern in patterns:
        found = F.size(F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(0))).cast("bigint")
        docs = docs.withColumns({f"n_{kind.lower()}": F.coalesce(found, F.lit(0)), text: F.regexp_replace(text, pattern, f"[{kind}]")})
    return docs


def language_profiles(docs: DataFrame, language: str = "lang", doc_id: str = "doc_id", text: str = "text",
                      counts: DataFrame | None = None) -> DataFrame:
    """(term, profile, size): how often each language uses a term, one entry per language, and how many documents with a language
    hold it. `counts` are the documents' term counts, if they are stored."""
    spoken = docs.where(F.col(language).isNotNull()).select(doc_id, language)
    if fits_broadcast(spoken, LABEL_ROWS):
        spoken = F.broadcast(spoken)
    known = (term_counts(docs, doc_id, text) if counts is None else counts).join(spoken, doc_id)
    summed = known.groupBy("term", language).agg(F.sum("n").alias("c"), F.count(F.lit(1)).alias("_size"))
    return summed.groupBy("term").agg(F.collect_list(F.struct(F.col(language).alias("language"), "c")).alias("profile"), F.sum("_size").alias("size"))


def guess_language(docs: DataFrame, profiles: DataFrame, doc_id: str = "doc_id", text: str = "text",
                   counts: DataFrame | None = None) -> DataFrame:
    """(doc_id, guess): the language whose term frequencies (with add-one smoothing) make the text
    likeliest, among those that share a term with it; the first by name on a tie. `profiles` is read
    more than once: pass a stored table."""
    sizes = profiles.select("term", F.explode("profile").alias("p")).groupBy("p.language").agg(F.sum("p.c").alias("n"))
    terms = profiles.agg(F.count(F.lit(1))).scalar()
    cost = F.ln(F.col("n") + terms)
    counted = term_counts(docs, doc_id, text) if counts is None else counts
    size = "size" if "size" in profiles.columns else None
    hits = lookup_join(counted, profiles, "term", "inner", spread_by=[doc_id], size=size).select(doc_id, "n", F.explode("profile").alias("p"))
    per = hits.groupBy(doc_id, "p.language").agg(F.sum(F.col("n") * F.ln(F.col("p.c") + 1)).alias("hit"))
    length = counted.groupBy(doc_id).agg(F.sum("n").alias("length"))
    scored = per.join(length, doc_id).join(sizes, "language").select(doc_id, "language", F.round(F.col("hit") - F.col("length") * cost, 6).alias("score"))
    return scored.groupBy(doc_id).agg(F.min_by("language", F.struct(-F.col("score"), "language")).alias("guess"))


def fit_router(docs: DataFrame, category: str, text: str = "text", features: int = 1 << 14, rounds: int = 20) -> PipelineModel:
    """A classifier of texts: hashed term frequencies, inverse document frequencies, logistic regression."""
    stages = [
        StringIndexer(inputCol=category, outputCol="_label", stringOrderType="alphabetAsc"),
        HashingTF(inputCol="_terms", outputCol="_tf", numFeatures=features),
        IDF(inputCol="_tf", outputCol="_x", minDocFreq=2),
        LogisticRegression(featuresCol="_x", labelCol="_label", predictionCol="_routed", maxIter=rounds, regParam=0.01),
    ]
    model = Pipeline(stages=stages).fit(docs.where(F.col(category).isNotNull()).withColumn("_terms", tx.terms(F.col(text))))
    return PipelineModel([*model.stages[1:], IndexToString(inputCol="_routed", outputCol="route", labels=model.stages[0].labels)])


def routed(docs: DataFrame, model: PipelineModel, text: str = "text") -> DataFrame:
    """Adds `route`, the category the model sends a document to; a text without terms gets its prior."""
    terms = F.coalesce(tx.terms(F.col(text)), F.array().cast("array<string>"))
    out = model.transform(docs.withColumn("_terms", terms))
    return out.select(*docs.columns, "route")


# ------------------------------------------------------------- sentiment


def learn_lexicon(docs: DataFrame, labels: DataFrame, label: str, doc_id: str = "doc_id", text: str = "text",
                  counts: DataFrame | None = None) -> DataFrame:
    """(term, weight, size): log-odds of a term in documents labelled 1 against those
    labelled 0, with add-one smoothing, and how many labelled documents hold it. Terms are counted within their row first
    (`counts`, if they are stored): the join to the labels moves counts, never texts, and nothing if the labels can be broadcast."""
    known = labels.select(doc_id, label)
    if fits_broadcast(known, LABEL_ROWS):
        known = F.broadcast(known)
    marked = (term_counts(docs, doc_id, text) if counts is None else counts).join(known, doc_id)
    good = F.col(label) == 1
    by_term = written(marked.groupBy("term").agg(
        F.coalesce(F.sum(F.when(good, F.col("n"))), F.lit(0)).alias("pos"),
        F.coalesce(F.sum(F.when(~good, F.col("n"))), F.lit(0)).alias("neg"),
        F.count(F.lit(1)).alias("size"),
    ), "marked")  # read twice, counted once
    totals = by_term.agg(
        F.struct(F.sum("pos").alias("p"), F.sum("neg").alias("n"), F.count(F.lit(1)).alias("v"))
    ).scalar()
    t = by_term.withColumn("_t", totals)
    up = F.ln((F.col("pos") + 1) / (F.col("_t.p") + F.col("_t.v")))
    down = F.ln((F.col("neg") + 1) / (F.col("_t.n") + F.col("_t.v")))
    return t.select("term", F.round(up - down, 6).alias("weight"), "size")


def sentiment(docs: DataFrame, lexicon: DataFrame, cut: float = 0.0, doc_id: str = "doc_id", text: str = "text",
              limit: int = BROADCAST_ROWS, counts: DataFrame | None = None) -> DataFrame:
    """Four scores that add up to 1 and the label with the highest one.

    A term above `cut` is positive, below -`cut` negative, others (and unknown
    ones) are neutral; the mixed score grows with the smaller of both sides. A
    document without terms is neutral. `lexicon` is read more than once: pass a
    stored table. `counts` are the documents' term counts, if they are stored.

    Only polar terms are looked up. Up to `limit` of them they are broadcast and a
    document is scored where it is read; beyond, this goes for the `limit` terms with the largest size (if the lexicon has sizes), counts of the
    other terms are shuffled, and then only sums of those found.
    """
    polar = lexicon.where(F.abs("weight") > cut)
    empty = docs.select(doc_id, F.lit(None).cast("string").alias("term"), F.lit(0).cast("bigint").alias("n"))
    w, n = F.col("weight"), F.col("n")
    sides = [F.sum(F.when(w > cut, n).otherwise(0)).alias("_p"), F.sum(F.when(w < -cut, n).otherwise(0)).alias("_n")]
    size = "size" if "size" in polar.columns else None
    if fits_broadcast(polar, limit):
        if counts is None:
            tokens = docs.select(doc_id, F.explode_outer(tx.terms(F.col(text))).alias("term"))
            tokens = tokens.withColumn("n", F.col("term").isNotNull().cast("bigint"))
        else:
            tokens = counts.unionByName(empty)
        full = lookup_join(tokens, polar, "term", limit=limit).groupBy(doc_id).agg(*sides, F.sum(n).alias("_all"))
    else:
        counted = written(term_counts(docs, doc_id, text), "terms") if counts is None else counts
        # The terms of most documents, polar or not, are told where a document is read; only the others are looked up.
        common = lexicon.select("term", "weight") if size is None else lexicon.where(F.length("term") <= COMMON_LENGTH).orderBy(F.col("size").desc(), "term").limit(limit).select("term", "weight")
        common = F.broadcast(written(common.limit(0) if size is None else common, "common"))
        rare = counted.where("term IS NOT NULL").join(common, "term", "left_anti").select(*counted.columns)
        found = lookup_join(rare, polar, "term", "inner", limit=limit, spread_by=[doc_id], size=size)
        found = found.select(doc_id, F.when(w > cut, n).otherwise(0).alias("_p"), F.when(w < -cut, n).otherwise(0).alias("_n"), F.lit(0).cast("bigint").alias("_all"))
        # Sums of all terms are made where a document is read.
        every = counted.unionByName(empty).join(common, "term", "left").groupBy(doc_id).agg(*sides, F.sum(n).alias("_all"))
        full = every.unionByName(found).groupBy(doc_id).agg(*[F.sum(c).alias(c) for c in ("_p", "_n", "_all")])
    mixed = F.least("_p", "_n") * 2
    raw = {"positive": F.col("_p"), "negative": F.col("_n"), "neutral": F.col("_all") - F.col("_p") - F.col("_n"), "mixed": mixed}
    total = F.col("_all") + mixed
    scores = {k: F.round(F.coalesce(safe_ratio(v.cast("double"), total), F.lit(1.0 if k == "neutral" else 0.0)), 6) for k, v in raw.items()}
    scored = full.select(doc_id, *[v.alias(k) for k, v in scores.items()])
    best = F.greatest(*scores)
    label = F.coalesce(*[F.when(F.col(s.lower()) == best, s) for s in SENTIMENTS])
    return scored.withColumn("sentiment", label)


def score_with(docs: DataFrame, scorer: Callable[[Iterator], Iterator], schema: str) -> DataFrame:
    """A user's own scorer in place of the lexicon: gets and yields pandas batches."""
    return docs.mapInPandas(scorer, schema)


# --------------------------------------------------------------- entities


def entity_list(text: Column, patterns: Sequence[tuple[str, str, float, str]] = ENTITY_PATTERNS) -> Column:
    """Sorted array of (type, text, score), one entry per match, repeats kept."""

    def matches(kind: str, pattern: str, score: float, literal: str) -> Column:
        searched = F.regexp_extract_all(text, F.lit(pattern), F.lit(1))
        if literal:
            none = F.array().cast("array<string>")
            searched = F.when(F.contains(text, F.lit(literal)), searched).when(text.isNotNull(), none)
        return F.transform(
            searched,
            lambda m: F.struct(F.lit(kind).alias("type"), m.alias("text"), F.lit(score).alias("score")),
        )

    return F.sort_array(F.concat(*[matches(*p) for p in patterns]))


def entities(docs: DataFrame, patterns: Sequence[tuple[str, str, float, str]] = ENTITY_PATTERNS,
             doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, type, text, score) rows."""
    found = docs.select(doc_id, F.explode(entity_list(F.col(text), patterns)).alias("_e"))
    return found.select(doc_id, "_e.*")


def entities_by_type(found: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Distinct (type, text) with their number of mentions, as rows: no list grows
    with the corpus."""
    return found.groupBy(*by, "type", "text").agg(F.count(F.lit(1)).alias("mentions"))


def common_types(found: DataFrame, k: int = 5) -> DataFrame:
    return stats.top_k(stats.value_counts(found, ["type"]), k, tie=["type"])


# ------------------------------------------------------------ key phrases


def phrase_counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", place: Sequence[str] = ()) -> DataFrame:
    """(doc_id, phrase, n) for pairs of neighbouring terms; `place` as in `item_counts`."""
    listed = docs.select(doc_id, tx.terms(F.col(text)).alias("_t"))
    length = F.greatest(F.size("_t") - 1, F.lit(0))
    pairs = F.zip_with(
        F.slice("_t", F.lit(1), length), F.slice("_t", F.lit(2), length), lambda a, b: F.concat_ws(" ", a, b)
    )
    return item_counts(listed, pairs, "phrase", doc_id, place)


def key_phrases(docs: DataFrame, k: int = 12, doc_id: str = "doc_id", text: str = "text",
                limit: int = BROADCAST_ROWS) -> DataFrame:
    """The k phrases of each document with the highest TF-IDF, phrase order on ties.

    Texts of more than PLAIN_CHARACTERS in all are taken in blocks (`blocks`): a block asks for the frequencies of its phrases by their
    hashes, so that only the leading phrases of a document are ever written out.

    Fewer are counted by their text. Most phrases occur in one document only. The stored table of document
    frequencies leaves them out: a phrase it does not hold has frequency 1.

    If that table is too large to broadcast, frequencies are first looked up for those phrases only that occur more than once in
    their document or are among its first ones by name. The others score at most what a phrase has that occurs once and nowhere else, and
    come later by name: where k phrases are ahead of them all, they are out. Documents where that is not so, and ids with several rows, are
    looked up whole.
    """
    total = docs.agg(F.count(F.lit(1))).scalar()
    order = W.partitionBy(doc_id).orderBy(F.col("score").desc(), "phrase")
    size, rows = docs.agg(F.coalesce(F.sum(F.length(text)), F.lit(0)), F.count(F.lit(1))).first()
    if size > PLAIN_CHARACTERS:
        leading = blocks.leading_pairs(docs.select(doc_id, tx.terms(F.col(text)).alias("_t")), "_t", k, rows, doc_id)
        scored = leading.select(F.col("id").alias(doc_id), "phrase", F.round(F.col("n") * F.ln((total + 1) / (F.col("df") + 1)), 6).alias("score"))
        return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    counts = written(phrase_counts(docs, doc_id, text, place=["_at"]), "phrases")  # read again below, tokenised once
    spread = counts.groupBy("phrase").agg(F.count(F.lit(1)).alias("_df")).where("_df > 1")
    repeated = written(spread, "frequencies")
    idf = F.ln((total + 1) / (F.coalesce("_df", F.lit(1)) + 1))

    def best(rows: DataFrame) -> DataFrame:
        joined = lookup_join(rows, repeated, "phrase", spread_by=[doc_id], size="_df", limit=limit)
        scored = joined.select(doc_id, "phrase", F.round(F.col("n") * idf, 6).alias("score"), "_at")
        return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(doc_id, "phrase", "score", "rank", "_at")

    if fits_broadcast(repeated, limit):
        return best(counts).drop("_at")
    first = F.col("_at") < 4 * k
    some = written(best(counts.where((F.col("n") > 1) | first)), "leading")
    rows = counts.groupBy(F.col(doc_id).alias("_doc")).agg(
        F.count(F.when((F.col("n") == 1) & ~first, 1)).alias("_left"), F.count(F.when(F.col("_at") == 0, 1)).alias("_rows"))
    most = F.round(F.ln((total + 1) / F.lit(2)), 6)
    ahead = (F.col("score") > most) | ((F.col("score") == most) & first)
    same = F.equal_null(doc_id, "_doc")
    judged = some.join(rows.where("_left > 0"), same).groupBy("_doc").agg(F.count(F.when(ahead & (F.col("_rows") == 1), 1)).alias("_ahead"))
    unsettled = written(judged.where(F.col("_ahead") < k).select("_doc"), "unsettled")
    if fits_broadcast(unsettled, LABEL_ROWS):
        unsettled = F.broadcast(unsettled)
    return some.join(unsettled, same, "left_anti").unionByName(best(counts.join(unsettled, same, "left_semi"))).drop("_at")


# ------------------------------------------------- results and reports


def analysis_rows(docs: DataFrame, key: Column, moods: DataFrame, phrases: DataFrame, as_of: Column,
                  patterns: Sequence[tuple[str, str, float, str]] = ENTITY_PATTERNS,
                  doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One nested result per document. The lists hold one document's own items;
    texts are shuffled once, for the joins on the document id."""
    per_doc = phrases.groupBy(doc_id).agg(
        F.sort_array(F.collect_list(F.struct("rank", "phrase", "score"))).alias("_p")
    )
    t = F.col(text)
    joined = docs.withColumn("_e", entity_list(t, patterns)).join(moods, doc_id, "left").join(per_doc, doc_id, "left")
    none_p = F.array().cast("array<struct<text:string,score:double>>")
    return joined.select(
        doc_id,
        key.alias("document"),
        F.date_format(as_of, "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"),
        t.alias("extracted_text"),
        F.struct(
            F.col("sentiment").alias("overall"),
            F.struct(*[F.col(s.lower()).alias(s.capitalize()) for s in SENTIMENTS]).alias("scores"),
        ).alias("sentiment"),
        F.transform("_e", lambda e: F.struct(e["text"].alias("text"), e["type"].alias("type"), e["score"].alias("score"))).alias("entities"),
        F.coalesce(
            F.transform("_p", lambda p: F.struct(p["phrase"].alias("text"), p["score"].alias("score"))), none_p
        ).alias("key_phrases"),
        F.struct(F.length(t).alias("text_length"), tx.word_count(t).alias("word_count")).alias("metadata"),
    )


def _pct(share: Column) -> Column:
    return F.format_string("%.1f%%", share * 100)


def document_report(results: DataFrame, phrases: int = 10) -> DataFrame:
    """(document, report): the summary text of each nested result."""
    types = F.array_sort(F.array_distinct(F.transform("entities", lambda e: e["type"])))
    listed = F.transform(
        types,
        lambda kind: F.concat(
            kind, F.lit(":\n"),
            F.array_join(
                F.transform(
                    F.array_sort(F.array_distinct(F.transform(
                        F.filter("entities", lambda e: e["type"] == kind), lambda e: e["text"]
                    ))),
                    lambda item: F.concat(F.lit("  - "), item),
                ),
                "\n",
            ),
        ),
    )
    top = F.transform(F.slice("key_phrases", 1, phrases), lambda p: F.concat(F.lit("  - "), p["text"]))

    def or_else(items: Column, message: str) -> Column:
        return F.when(F.size(items) > 0, F.array_join(items, "\n")).otherwise(message)

    scores = [
        F.concat(F.lit(f"  {s.lower()} "), _pct(F.col(f"sentiment.scores.{s.capitalize()}"))) for s in SENTIMENTS
    ]
    lines = [
        F.concat(F.lit("# "), F.col("document"), F.lit(", read on "), F.col("timestamp")),
        F.format_string("%s words in %s characters", F.col("metadata.word_count").cast("string"), F.col("metadata.text_length").cast("string")),
        F.concat(F.lit("## Mood: "), F.col("sentiment.overall")),
        *scores,
        F.lit("## Names, places and numbers"),
        or_else(listed, "  (none)"),
        F.lit("## Leading phrases"),
        or_else(top, "  (none)"),
    ]
    return results.select("document", F.concat_ws("\n", *lines).alias("report"))


def corpus_totals(results: DataFrame) -> DataFrame:
    """One row of totals, averages and the extreme documents; NULL averages for an
    empty corpus."""
    n = F.count(F.lit(1))
    words = F.sum("metadata.word_count")
    ents, phr = F.sum(F.size("entities")), F.sum(F.size("key_phrases"))
    pos, neg = F.col("sentiment.scores.Positive"), F.col("sentiment.scores.Negative")
    return results.agg(
        n.alias("documents"),
        words.alias("total_words"),
        safe_ratio(words, n).alias("avg_words"),
        ents.alias("total_entities"),
        safe_ratio(ents, n).alias("avg_entities"),
        phr.alias("total_phrases"),
        safe_ratio(phr, n).alias("avg_phrases"),
        F.min_by(F.struct(tx.basename(F.col("document")).alias("document"), pos.alias("score")), stats.extreme_order(-pos, F.col("doc_id"))).alias("most_positive"),
        F.min_by(F.struct(tx.basename(F.col("document")).alias("document"), neg.alias("score")), stats.extreme_order(-neg, F.col("doc_id"))).alias("most_negative"),
    )


def corpus_report(results: DataFrame) -> DataFrame:
    """(section, position, line) rows of the corpus report. The listing of all
    documents is one row each, so the report is written by many tasks. `results`
    is read several times: pass a stored table."""
    totals = corpus_totals(results)

    def row(section: int, lines: Sequence[Column]) -> Column:
        return F.explode(F.array(*[
            F.struct(F.lit(section).alias("section"), F.lit(f"{i:02d}").alias("position"), line.alias("line"))
            for i, line in enumerate(lines)
        ])).alias("_r")

    def text(label: str, value: Column) -> Column:
        return F.concat(F.lit(label), value)

    def extreme(label: str, c: str) -> Column:
        return F.concat(F.lit(label), F.col(f"{c}.document"), F.lit(" ("), _pct(F.col(f"{c}.score")), F.lit(")"))

    head = totals.select(row(1, [
        text("documents = ", F.col("documents").cast("string")),
        text("words = ", F.format_number("total_words", 0)),
        text("words a document = ", F.format_string("%.0f", "avg_words")),
        text("entities = ", F.format_number("total_entities", 0)),
        text("entities a document = ", F.format_string("%.1f", "avg_entities")),
        text("phrases a document = ", F.format_string("%.1f", "avg_phrases")),
        extreme("happiest = ", "most_positive"),
        extreme("angriest = ", "most_negative"),
    ])).select("_r.*")
    mood = stats.with_share(stats.value_counts(results.select(F.col("sentiment.overall").alias("sentiment")), ["sentiment"]))
    moods = mood.select(
        F.lit(2).alias("section"), F.col("sentiment").alias("position"),
        F.format_string("mood %s = %d, %.1f%% of all", "sentiment", "n", "share_pct").alias("line"),
    )
    kinds = common_types(results.select(F.explode("entities.type").alias("type")))
    types = kinds.select(
        F.lit(3).alias("section"), F.col("type").alias("position"), F.format_string("kind %s = %d", "type", "n").alias("line")
    )
    listing = results.select(
        F.lit(4).alias("section"), F.col("document").alias("position"),
        F.concat(F.lit("document "), tx.basename(F.col("document")), F.lit(" = "), F.col("sentiment.overall")).alias("line"),
    )
    return head.unionByName(moods).unionByName(types).unionByName(listing)
