"""Document analytics over the whole texts."""

from pyspark.sql import functions as F

from millrace.functions import text as tx
from millrace.operators import documents as dx, phrases, prepare, recogniser, stats, topics
from millrace.plans.registry import query
from millrace.session import scratch_path, written
from millrace.sources import writers

CUT = 0.25
AS_OF = "2024-02-01 00:00:00"

_MOOD = r"""tc AS (SELECT doc_id, term, count(*) AS n FROM (SELECT doc_id, unnest(regexp_extract_all(lower(text), '\p{L}+')) AS term FROM documents) GROUP BY 1, 2),
  lx AS (SELECT term, coalesce(sum(n) FILTER (quality = 1), 0) AS pos, coalesce(sum(n) FILTER (quality = 0), 0) AS neg FROM tc JOIN labels USING (doc_id) GROUP BY 1),
  lt AS (SELECT sum(pos) AS p, sum(neg) AS n, count(*) AS v FROM lx),
  lw AS (SELECT term, round(ln((pos + 1) / (p + v)::DOUBLE) - ln((neg + 1) / (n + v)::DOUBLE), 6) AS weight FROM lx, lt),
  ta AS (SELECT doc_id, coalesce(sum(n) FILTER (weight > 0.25), 0) AS p, coalesce(sum(n) FILTER (weight < -0.25), 0) AS g, sum(n) AS a FROM tc LEFT JOIN lw USING (term) GROUP BY 1),
  fu AS (SELECT d.doc_id, d.lang, coalesce(p, 0)::DOUBLE AS p, coalesce(g, 0)::DOUBLE AS g, coalesce(a, 0)::DOUBLE AS a FROM documents d LEFT JOIN ta USING (doc_id)),
  sc AS (SELECT doc_id, lang, round(coalesce(p / nullif(a + 2 * least(p, g), 0), 0), 6) AS positive, round(coalesce(g / nullif(a + 2 * least(p, g), 0), 0), 6) AS negative,
                round(coalesce((a - p - g) / nullif(a + 2 * least(p, g), 0), 1), 6) AS neutral, round(coalesce(2 * least(p, g) / nullif(a + 2 * least(p, g), 0), 0), 6) AS mixed FROM fu),
  mood AS (SELECT *, CASE greatest(positive, negative, neutral, mixed) WHEN positive THEN 'POSITIVE' WHEN negative THEN 'NEGATIVE' WHEN neutral THEN 'NEUTRAL' ELSE 'MIXED' END AS sentiment FROM sc)"""


def _found_sql() -> str:
    parts = [
        f"SELECT doc_id, '{kind}' AS type, unnest(regexp_extract_all(text, '{pattern}', 1)) AS text, {score}::DOUBLE AS score FROM documents"
        for kind, pattern, score, _ in dx.ENTITY_PATTERNS
    ]
    return "found AS (" + " UNION ALL ".join(parts) + ")"


_FOUND = _found_sql()

_PHRASES = r"""tk AS (SELECT doc_id, regexp_extract_all(lower(text), '\p{L}+') AS t FROM documents),
  bg AS (SELECT doc_id, t[i] || ' ' || t[i + 1] AS phrase FROM (SELECT doc_id, t, unnest(generate_series(1, len(t) - 1)) AS i FROM tk)),
  pc AS (SELECT doc_id, phrase, count(*) AS n FROM bg GROUP BY 1, 2), pd AS (SELECT phrase, count(*) AS df FROM pc GROUP BY 1),
  ps AS (SELECT doc_id, phrase, round(n * ln(((SELECT count(*) FROM documents) + 1) / (df + 1)::DOUBLE), 6) AS score FROM pc JOIN pd USING (phrase)),
  phrases AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, phrase) AS rank FROM ps) WHERE rank <= 12)"""


def moods(t, **settings):
    docs = t.spread("documents", "doc_id")
    counts = written(dx.term_counts(docs), "terms")  # read twice, tokenised once
    lexicon = written(dx.learn_lexicon(docs, t.labels, "quality", counts=counts), "lexicon")
    return dx.sentiment(docs, lexicon, CUT, counts=counts, **settings)


def results(t, mood=None):
    key = F.concat(F.lit("uploads/"), F.col("doc_id").cast("string"), F.lit(".txt"))
    return dx.analysis_rows(
        t.spread("documents", "doc_id"), key, moods(t) if mood is None else mood, dx.key_phrases(t.spread("documents", "doc_id")), F.lit(AS_OF).cast("timestamp")
    )


@query("DOC3", f"WITH {_MOOD} SELECT doc_id, positive, negative, neutral, mixed, sentiment FROM mood")
def document_sentiment(t):
    return moods(t)


@query("DOC4", f"WITH {_FOUND} SELECT doc_id, type, text, score FROM found")
def document_entities(t):
    return dx.entities(t.spread("documents", "doc_id"))


@query("DOC4")
def recognised_entities(t):
    # Learned from the pattern hits of four fifths of the documents, compared with those of the others, type by type.
    docs = prepare.assign_split(t.spread("documents", "doc_id").select("doc_id", "text"), "doc_id")
    known = docs.withColumn("hits", dx.entity_list(F.col("text")))
    model = recogniser.fit(known.where("split = 'train'"))
    test = docs.where("split = 'test'")
    found = recogniser.recognised(test, model).select("doc_id", "type", "text").distinct().withColumn("found", F.lit(1))
    wanted = dx.entities(test).select("doc_id", "type", "text").distinct().withColumn("wanted", F.lit(1))
    both = found.join(wanted, ["doc_id", "type", "text"], "full")
    return both.groupBy("type").agg(F.count("wanted").alias("wanted"), F.count("found").alias("found"), F.count(F.when(F.col("wanted") == F.col("found"), 1)).alias("right"))


@query("DOC5", f"WITH {_PHRASES} SELECT doc_id, phrase, score, rank FROM phrases")
def key_phrases(t):
    return dx.key_phrases(t.spread("documents", "doc_id")).withColumn("rank", F.col("rank").cast("bigint"))


_RUNS = r"""tk AS (SELECT doc_id, regexp_extract_all(lower(text), '\p{L}+') AS t FROM documents),
  rn AS (SELECT array_to_string(list_slice(t, i, i + l - 1), ' ') AS phrase, l FROM (SELECT t, l, unnest(generate_series(1, len(t) - l + 1)) AS i FROM tk, range(1, 6) r(l))),
  fr AS (SELECT phrase, l, count(*) AS n FROM rn GROUP BY 1, 2 HAVING count(*) >= 20),
  lg AS (SELECT phrase, max(n) AS most FROM (SELECT regexp_replace(phrase, ' [^ ]+$', '') AS phrase, n FROM fr WHERE l > 2 UNION ALL SELECT regexp_replace(phrase, '^[^ ]+ ', ''), n FROM fr WHERE l > 2) GROUP BY 1)"""


@query(
    "DOC5",
    f"""WITH {_RUNS} SELECT f.phrase, f.l::INT AS length, f.n, round(round((f.n - b.n * w.n / (SELECT count(*) FROM rn WHERE l = 1)::DOUBLE) / sqrt(f.n), 6), 4) AS significance
        FROM fr f JOIN fr b ON b.phrase = regexp_replace(f.phrase, ' [^ ]+$', '') JOIN fr w ON w.phrase = regexp_extract(f.phrase, '[^ ]+$') LEFT JOIN lg ON lg.phrase = f.phrase
        WHERE f.l > 1 AND coalesce(lg.most, 0) < 0.8 * f.n AND round((f.n - b.n * w.n / (SELECT count(*) FROM rn WHERE l = 1)::DOUBLE) / sqrt(f.n), 6) >= 2""",
)
def whole_phrases(t):
    # Phrases of two to five terms, without those that are part of a longer one.
    found, _ = phrases.mined(t.spread("documents", "doc_id"), least=20, longest=5)
    return phrases.whole(found).withColumn("significance", F.round("significance", 4))


@query("DOC6 SRT5", f"WITH {_PHRASES} SELECT doc_id, string_agg(phrase, '; ' ORDER BY rank) AS top_phrases FROM phrases WHERE rank <= 10 GROUP BY 1")
def report_phrases(t):
    # At most ten phrases per document meet in a group.
    ranked = dx.key_phrases(t.spread("documents", "doc_id"), 10).groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("rank", "phrase"))).alias("p"))
    return ranked.select("doc_id", F.array_join(F.col("p.phrase"), "; ").alias("top_phrases"))


@query("DOC7 AGG18", f"WITH {_FOUND} SELECT type, text, count(*) AS mentions FROM found GROUP BY 1, 2")
def entities_by_type(t):
    return dx.entities_by_type(dx.entities(t.spread("documents", "doc_id")))


@query("DOC8 SNK4 ARR-F3 JSON-F2")
def nested_results(t):
    path = scratch_path(t.spark, "analyses")
    rows = results(t)
    writers.json(rows, path)
    return t.spark.read.schema(rows.schema).json(path)


@query(
    "DOC8 SNK4",
    rf"""WITH {_MOOD}, {_FOUND}, {_PHRASES}, e AS (SELECT doc_id, count(*) AS n FROM found GROUP BY 1),
         p AS (SELECT doc_id, count(*) AS n, min(phrase) FILTER (rank = 1) AS first, max(score) AS top FROM phrases GROUP BY 1)
         SELECT d.doc_id, 'uploads/' || d.doc_id || '.txt' AS document, sentiment AS overall, positive, coalesce(e.n, 0)::INT AS entities, coalesce(p.n, 0)::INT AS phrases,
                p.first AS first_phrase, p.top AS phrase_score, length(d.text)::INT AS text_length, md5(d.text) AS text_digest
         FROM documents d JOIN mood USING (doc_id) LEFT JOIN e USING (doc_id) LEFT JOIN p USING (doc_id)""",
)
def nested_results_flat(t):
    # The nested documents as they come back from their files, laid flat.
    rows = nested_results(t)
    return rows.select(
        "doc_id", "document", F.col("sentiment.overall").alias("overall"), F.col("sentiment.scores.Positive").alias("positive"),
        F.size("entities").alias("entities"), F.size("key_phrases").alias("phrases"), F.get(F.col("key_phrases.text"), F.lit(0)).alias("first_phrase"),
        F.get(F.col("key_phrases.score"), F.lit(0)).alias("phrase_score"), F.col("metadata.text_length").alias("text_length"), F.md5("extracted_text").alias("text_digest"))


@query(
    "DOC9",
    """SELECT CASE WHEN length(trim(text)) < 40 THEN 'failed' ELSE 'processed' END AS status, count(*) AS n, round(count(*) * 100.0 / sum(count(*)) OVER (), 6) AS share_pct FROM documents GROUP BY 1""",
)
def processing_status(t):
    key = F.concat(F.col("doc_id").cast("string"), F.lit(".txt"))
    rows = dx.processing_status(t.documents, key, F.col("text"), min_chars=40)
    return stats.with_share(stats.value_counts(rows, ["status"])).withColumn("share_pct", F.round("share_pct", 6))


@query("DOC10", f"WITH {_MOOD} SELECT sentiment, count(*) AS n, round(count(*) * 100.0 / sum(count(*)) OVER (), 6) AS share_pct FROM mood GROUP BY 1")
def sentiment_distribution(t):
    shared = stats.with_share(written(stats.value_counts(moods(t), ["sentiment"]), "sentiments"))  # read twice
    return shared.withColumn("share_pct", F.round("share_pct", 6))


@query("DOC11 SRT4", f"WITH {_FOUND} SELECT type, count(*) AS n FROM found GROUP BY 1 ORDER BY n DESC, type LIMIT 5")
def common_entity_types(t):
    return dx.common_types(dx.entities(t.spread("documents", "doc_id")))


@query(
    "DOC12 AGG12 AGG19",
    rf"""WITH {_FOUND}, {_PHRASES}, w AS (SELECT sum(len(list_filter(regexp_split_to_array(text, '{tx.BLANKS}'), lambda x: x <> ''))) AS words, count(*) AS n FROM documents)
         SELECT n AS documents, words::BIGINT AS total_words, round(words / n, 6) AS avg_words, (SELECT count(*) FROM found) AS total_entities,
                round((SELECT count(*) FROM found) / n, 6) AS avg_entities, (SELECT count(*) FROM phrases) AS total_phrases, round((SELECT count(*) FROM phrases) / n, 6) AS avg_phrases FROM w""",
)
def corpus_totals(t):
    # Without the moods, which none of these totals needs.
    unknown = t.spark.createDataFrame([], ", ".join(["doc_id bigint", "sentiment string", *[f"{s.lower()} double" for s in dx.SENTIMENTS]]))
    totals = dx.corpus_totals(results(t, unknown)).drop("most_positive", "most_negative")
    return totals.withColumns({c: F.round(c, 6) for c in ("avg_words", "avg_entities", "avg_phrases")})


@query(
    "DOC13 AGG14",
    f"""WITH {_MOOD} SELECT 'positive' AS kind, doc_id, positive AS score FROM (SELECT * FROM mood ORDER BY positive DESC, doc_id LIMIT 1)
        UNION ALL SELECT 'negative', doc_id, negative FROM (SELECT * FROM mood ORDER BY negative DESC, doc_id LIMIT 1)""",
)
def extreme_sentiments(t):
    m = written(moods(t), "moods")  # read twice
    best = [
        stats.extreme_rows(m, c, "doc_id", []).select(F.lit(c).alias("kind"), "highest.doc_id", F.col(f"highest.{c}").alias("score"))
        for c in ("positive", "negative")
    ]
    return best[0].unionByName(best[1])


@query("DOC14", f"WITH {_MOOD} SELECT doc_id || '.txt' AS document, sentiment FROM mood")
def label_listing(t):
    return moods(t).select(F.concat(F.col("doc_id").cast("string"), F.lit(".txt")).alias("document"), "sentiment")


@query("DOC15 SNK5 STR-F8")
def document_reports(t):
    return dx.document_report(results(t))


@query("DOC16 SNK5")
def corpus_report(t):
    path = scratch_path(t.spark, "report")
    lines = dx.corpus_report(written(results(t), "analyses"))
    writers.report(lines.orderBy("section", "position"), path, "line")
    return t.spark.read.text(path).withColumnRenamed("value", "line")


@query(
    "DOC17",
    r"""WITH s AS (SELECT nullif(regexp_extract(split_part(url, '/', -1), '\.([^.]*)$', 1), '') AS suffix, html FROM pages)
        SELECT CASE WHEN suffix IS NOT NULL AND suffix <> 'txt' THEN 'unsupported' WHEN length(trim(html)) < 10 THEN 'failed' ELSE 'processed' END AS status, count(*) AS n FROM s GROUP BY 1""",
)
def routed_by_extension(t):
    rows = dx.processing_status(t.pages, F.col("url"), F.col("html"))
    return stats.value_counts(rows, ["status"])


@query("DOC18", f"WITH {_MOOD} SELECT doc_id, negative FROM mood WHERE sentiment = 'NEGATIVE'")
def negative_alerts(t):
    return moods(t).where("sentiment = 'NEGATIVE'").select("doc_id", "negative")


@query("DOC19", f"WITH {_MOOD} SELECT lang, sentiment, count(*) AS n FROM mood GROUP BY 1, 2")
def sentiment_by_language(t):
    return moods(t).join(t.documents.select("doc_id", "lang"), "doc_id").groupBy("lang", "sentiment").agg(F.count(F.lit(1)).alias("n"))


@query(
    "DOC22",
    """WITH d AS (SELECT event_type, strftime(ts, '%Y-%m-%d') AS day, count(*) AS n FROM events GROUP BY 1, 2)
       SELECT event_type, day, n, lag(n) OVER (PARTITION BY event_type ORDER BY day) AS prev_n, n - lag(n) OVER (PARTITION BY event_type ORDER BY day) AS change FROM d""",
)
def volume_trend(t):
    from millrace.operators.feature_store import version_changes

    daily = t.events.groupBy("event_type", F.date_format("ts", "yyyy-MM-dd").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    return version_changes(written(daily, "daily"), ["event_type"], ["day"], "n")


@query(
    "DOC22",
    f"""WITH {_MOOD}, d AS (SELECT sentiment, doc_id % 28 AS day, count(*) AS n FROM mood GROUP BY 1, 2)
       SELECT sentiment, day, n, lag(n) OVER (PARTITION BY sentiment ORDER BY day) AS prev_n, n - lag(n) OVER (PARTITION BY sentiment ORDER BY day) AS change FROM d""",
)
def sentiment_trend(t):
    from millrace.operators.feature_store import version_changes

    # The documents carry no date: the id stands in for the day of a month.
    daily = moods(t).groupBy("sentiment", (F.col("doc_id") % 28).alias("day")).agg(F.count(F.lit(1)).alias("n"))
    return version_changes(written(daily, "daily"), ["sentiment"], ["day"], "n")


def _personal_sql() -> str:
    step, columns = "SELECT doc_id, text FROM documents", []
    for kind, pattern in dx.PERSONAL:
        name = f"n_{kind.lower()}"
        step = f"SELECT doc_id, {''.join(c + ', ' for c in columns)}len(regexp_extract_all(text, '{pattern}')) AS {name}, regexp_replace(text, '{pattern}', '[{kind}]', 'g') AS text FROM ({step})"
        columns.append(name)
    return f"SELECT doc_id, {', '.join(columns)}, md5(text) AS redacted FROM ({step})"


@query("DOC20", _personal_sql())
def personal_data(t):
    rows = dx.redact_personal(t.spread("documents", "doc_id").select("doc_id", "text"))
    return rows.withColumn("redacted", F.md5("text")).drop("text")


@query(
    "DOC19",
    r"""WITH tc AS (SELECT doc_id, term, count(*) AS n FROM (SELECT doc_id, unnest(regexp_extract_all(lower(text), '\p{L}+')) AS term FROM documents) GROUP BY 1, 2),
      p AS (SELECT term, lang, sum(n) AS c FROM tc JOIN documents USING (doc_id) WHERE lang IS NOT NULL GROUP BY 1, 2),
      z AS (SELECT lang, sum(c) AS n FROM p GROUP BY 1), v AS (SELECT count(DISTINCT term) AS v FROM p), l AS (SELECT doc_id, sum(n) AS len FROM tc GROUP BY 1),
      h AS (SELECT doc_id, lang, sum(tc.n * ln(c + 1)) AS hit FROM tc JOIN p USING (term) GROUP BY 1, 2),
      r AS (SELECT doc_id, h.lang, round(hit - len * ln(z.n + v), 6) AS score FROM h JOIN l USING (doc_id) JOIN z USING (lang), v)
      SELECT doc_id, lang AS guess FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, lang) AS k FROM r) WHERE k = 1""",
)
def language_guess(t):
    docs = t.spread("documents", "doc_id")
    counts = written(dx.term_counts(docs), "terms")  # read more than once, tokenised once
    return dx.guess_language(docs, written(dx.language_profiles(docs, counts=counts), "profiles"), counts=counts)


@query("DOC23")
def document_routes(t):
    docs = prepare.assign_split(t.spread("documents", "doc_id").select("doc_id", "text", "lang"), "doc_id")
    model = dx.fit_router(docs.where("split = 'train'"), "lang")
    return dx.routed(docs, model).select("doc_id", "split", "lang", "route")


@query("DOC21")
def corpus_topics(t):
    return topics.topics(t.spread("documents", "doc_id"))


@query(
    "DOC21",
    r"""WITH tc AS (SELECT doc_id, term, count(*) AS n FROM (SELECT doc_id, unnest(regexp_extract_all(lower(text), '\p{L}+')) AS term FROM documents) GROUP BY 1, 2),
        c AS (SELECT * FROM tc WHERE term IN (SELECT term FROM tc GROUP BY 1 HAVING count(*) >= 2)),
        m AS (SELECT term, i, 1 + ('0x' || substr(md5('42:' || i || ':' || term), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS m FROM (SELECT DISTINCT term FROM c), range(4) r(i)),
        p AS (SELECT term, i, (m + 0.01) / (sum(m) OVER (PARTITION BY i) + 0.01 * count(*) OVER (PARTITION BY i)) AS p FROM m),
        q AS (SELECT term, sum(p) / 4 AS chance FROM p GROUP BY 1)
        SELECT i::INT AS topic, round(sum(n * p / 4 / chance), 3) AS tokens, (SELECT round(sum(n * ln(chance)), 2) FROM c JOIN q USING (term)) AS fit
        FROM c JOIN p USING (term) JOIN q USING (term) GROUP BY 1""",
)
def topic_round(t):
    # One round from even topics of the documents: what every topic then holds, and how likely the texts were.
    model = topics.refine(topics.begin(t.spread("documents", "doc_id"), k=4))
    rows = [(i, round(m, 3), round(model.objective[0], 2)) for i, m in enumerate(model.totals)]
    return t.spark.createDataFrame(rows, "topic int, tokens double, fit double")


@query("UDF1", "SELECT doc_id, round((length(text) - length(replace(text, ',', '')))::DOUBLE / length(text), 6) AS score FROM documents")
def user_scorer(t):
    def commas(batches):
        for b in batches:
            yield b.assign(score=b["text"].str.count(",") / b["text"].str.len())[["doc_id", "score"]]

    scores = dx.score_with(t.documents.select("doc_id", "text"), commas, "doc_id bigint, score double")
    return scores.withColumn("score", F.round("score", 6))
