"""Streams over files and event tables. Every stateful step is a keyed aggregate
with a watermark (partial sums before the shuffle, state dropped when a window
closes), written in append mode."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F, types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from millrace.functions.numeric import change_pct
from millrace.functions.time import utc
from millrace.operators.feature_store import FeatureGroup, conform
from millrace.operators.relational import heavy_keys, latest_by, lookup_join
from millrace.operators.snapshots import LatestView
from millrace.session import scratch_path


def arriving(spark: SparkSession, path: str, schema: T.StructType, pattern: str | None = None,
             files_per_trigger: int | None = None, time: str | None = None) -> DataFrame:
    """New Parquet files below a prefix as a stream; `time` is made a UTC timestamp."""
    reader = spark.readStream.schema(schema).format("parquet")
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    stream = reader.load(path)
    return stream.withColumn(time, utc(F.col(time))) if time else stream


def drained(stream: DataFrame, label: str, path: str | None = None) -> tuple[DataFrame, str | None]:
    """Process everything available, append to a table; returns that table and the final
    watermark (None if the job has none or got no rows)."""
    spark = stream.sparkSession
    path = path or scratch_path(spark, label)
    query = (
        stream.writeStream.format("parquet")
        .option("checkpointLocation", scratch_path(spark, f"{label}-checkpoint"))
        .outputMode("append")
        .trigger(availableNow=True)
        .start(path)
    )
    query.awaitTermination()
    marks = [p["eventTime"]["watermark"] for p in query.recentProgress if "watermark" in p["eventTime"]]
    return spark.read.schema(stream.schema).parquet(path), marks[-1] if marks else None


def drain(stream: DataFrame, label: str, path: str | None = None) -> DataFrame:
    """Process everything available, append to a table, and read that table."""
    return drained(stream, label, path)[0]


def finished(stream: DataFrame, table: DataFrame, job: Callable[[DataFrame], DataFrame], time: str, period: str, label: str) -> DataFrame:
    """All windows of a bounded input. The stream emits those that the watermark has closed;
    `table` holds the same rows at rest, and the windows still open at the end are computed
    from its newest rows. A row of an open window was never late, so nothing is counted
    twice or missed; rows that came too late for a closed window are in `dropped`."""
    closed, mark = drained(job(stream), label)
    if mark is None:
        return job(table)
    end = utc(F.lit(mark).cast("timestamp"))
    newest = table.where((F.col(time) >= end - F.expr(f"INTERVAL {period}")) & (F.window(time, period)["end"] > end))
    return closed.unionByName(job(newest))


def dropped(result: DataFrame, table: DataFrame, time: str, period: str, by: Sequence[str], n: str = "n") -> DataFrame:
    """Rows per window and group that arrived too late: all rows less those in the result."""
    every = table.groupBy(F.window(time, period)["start"].alias("window_start"), *by).agg(F.count(F.lit(1)).alias("_all"))
    seen = result.select("window_start", *by, F.col(n).alias("_seen"))
    rows = every.join(seen, ["window_start", *by], "left").withColumn("late", F.col("_all") - F.coalesce("_seen", F.lit(0)))
    return rows.where("late > 0").drop("_all", "_seen")


def windowed(stream: DataFrame, time: str, delay: str, period: str, by: Sequence[str], value: str,
             offset: str | None = None) -> DataFrame:
    """Tumbling-window counts and value statistics; a window is emitted once the
    watermark (newest time - delay) has passed its end."""
    return (
        stream.withWatermark(time, delay)
        .groupBy(F.window(time, period, startTime=offset), *by)
        .agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("total"), F.min(value).alias("low"), F.max(value).alias("high"))
        .select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *by, "n", "total", "low", "high")
    )


def late_rows(df: DataFrame, time: str, arrival: str, batch: str, delay: str) -> DataFrame:
    """Adds `late`: the row arrives when the batches before it had already moved
    the watermark past its time. Batches are periods of arrival time, so the
    table of batches grows with the calendar, not with the rows."""
    rows = df.withColumn("_batch", F.window(utc(F.col(arrival)), batch)["start"])
    newest = rows.groupBy("_batch").agg(F.max(time).alias("_newest"))
    earlier = W.orderBy("_batch").rowsBetween(W.unboundedPreceding, -1)
    mark = newest.select("_batch", (F.max("_newest").over(earlier) - F.expr(f"INTERVAL {delay}")).alias("_mark"))
    return lookup_join(rows, mark, "_batch").withColumn("late", F.coalesce(F.col(time) < F.col("_mark"), F.lit(False))).drop("_batch", "_mark")


def ingest_stream(stream: DataFrame, group: FeatureGroup, path: str) -> tuple[DataFrame, DataFrame]:
    """Append accepted records to the group's history and rejected ones, as they came, to a table
    beside it; returns both. A batch that is repeated replaces its own files."""
    spark, raw = stream.sparkSession, stream.schema
    for name, schema in (("accepted", group.schema), ("rejected", raw)):
        spark.createDataFrame([], schema).write.parquet(f"{path}/{name}/batch=none")

    def write(batch: DataFrame, number: int) -> None:
        accepted, rejected = conform(batch, group)
        accepted.write.mode("overwrite").parquet(f"{path}/accepted/batch={number}")
        rejected.write.mode("overwrite").parquet(f"{path}/rejected/batch={number}")

    _each_batch(stream, write, f"ingest-{group.table}")
    history = spark.read.schema(group.schema).parquet(f"{path}/accepted/*")
    return history, spark.read.schema(raw).parquet(f"{path}/rejected/*")


def _each_batch(stream: DataFrame, write: Callable[[DataFrame, int], None], label: str, checkpoint: str | None = None) -> None:
    query = (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint or scratch_path(stream.sparkSession, f"{label}-checkpoint"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def monitored(stream: DataFrame, baseline: DataFrame, time: str, delay: str, period: str, by: str, value: str,
              threshold: float = 20.0) -> DataFrame:
    """Windows beside the static baseline mean of their group, with the change and an
    alert (NULL without a baseline)."""
    closed = windowed(stream, time, delay, period, [by], value)
    joined = closed.join(baseline.select(by, F.col("mean").alias("baseline")), by, "left")
    mean = F.col("total") / F.col("n")
    pct = change_pct(F.col("baseline"), mean)
    return joined.select(
        "window_start", by, "n", mean.alias("mean"), "baseline", pct.alias("change_pct"),
        (F.abs(pct) > threshold).alias("alert"),
    )


def distribution(stream: DataFrame, edges: Sequence[float], time: str, delay: str, period: str, by: Sequence[str], value: str) -> DataFrame:
    """(window_start, by..., n, counts): how many values of each window lie in each bin of a fixed list of inner edges (the
    upper edge belongs to the bin). Counts of parts of a window add up, so partial sums are made before the shuffle."""
    above = sum((F.when(F.col(value) > e, 1).otherwise(0) for e in edges), F.lit(0))
    bins = [F.count(F.when(F.col("_bin") == i, 1)) for i in range(len(edges) + 1)]
    known = stream.where(F.col(value).isNotNull()).withColumn("_bin", above).withWatermark(time, delay)
    counted = known.groupBy(F.window(time, period), *by).agg(F.count(F.lit(1)).alias("n"), *[b.alias(f"_c{i}") for i, b in enumerate(bins)])
    return counted.select(F.col("window.start").alias("window_start"), *by, "n", F.array(*[f"_c{i}" for i in range(len(bins))]).alias("counts"))


def distribution_drift(windows: DataFrame, baseline: Sequence[int], edges: Sequence[float], ends: tuple[float, float], floor: float = 1e-4) -> DataFrame:
    """Adds psi, ks, p50 and p95 to windows of `distribution`, against the counts of the same bins in a baseline.

    `psi` compares shares, none less than `floor`. `ks` is the largest difference of the two distributions at an edge: the true one is
    larger by no more than the largest share of a bin. A quantile is the upper edge of the bin it lies in, `ends` being the
    lowest and highest value there is: the true one is less by no more than the width of the bin."""
    total = max(sum(baseline), 1)
    old = F.array(*[F.lit(b / total) for b in baseline])
    share = F.transform("counts", lambda c: c / F.col("n"))
    parts = F.zip_with(share, old, lambda a, b: (F.greatest(a, F.lit(floor)) - F.greatest(b, F.lit(floor))) * F.ln(F.greatest(a, F.lit(floor)) / F.greatest(b, F.lit(floor))))
    uppers = F.array(*[F.lit(float(e)) for e in [*edges, ends[1]]])
    places = F.sequence(F.lit(0), F.lit(len(baseline) - 1))

    def up_to(array: Column) -> Column:
        return F.transform(places, lambda i: F.aggregate(F.slice(array, F.lit(1), i + 1), F.lit(0.0), lambda a, x: a + x))

    def quantile(q: float) -> Column:
        seen = F.transform(places, lambda i: F.aggregate(F.slice("counts", F.lit(1), i + 1), F.lit(0).cast("long"), lambda a, x: a + x))
        return F.get(uppers, F.size(F.filter(seen, lambda c: c < F.ceil(F.col("n") * q))))

    gaps = F.zip_with(up_to(share), up_to(old), lambda a, b: F.abs(a - b))
    return windows.select("*", F.aggregate(parts, F.lit(0.0), lambda a, x: a + x).alias("psi"), F.array_max(gaps).alias("ks"), quantile(0.5).alias("p50"), quantile(0.95).alias("p95"))


def split_late(stream: DataFrame, time: str, delay: str, path: str | None = None) -> tuple[DataFrame, DataFrame]:
    """The rows of the running stream in two tables: those in time, and late ones, which come when earlier batches had already
    moved the watermark (newest time - delay) past theirs. The mark after each batch is stored beside its rows, so a
    repeated batch comes out the same, and a stream that is started again with the same `path` goes on where it was. Rows
    without a time are in time."""
    spark, schema, path = stream.sparkSession, stream.schema, path or scratch_path(stream.sparkSession, "late")
    for name in ("kept", "late"):
        spark.createDataFrame([], schema).write.mode("overwrite").parquet(f"{path}/{name}/batch=none")

    def write(batch: DataFrame, number: int) -> None:
        old = spark.read.schema("mark timestamp").parquet(f"{path}/marks/batch={number - 1}").first().mark if number else None
        rows = batch.persist()
        try:
            late = F.coalesce(F.col(time) < F.lit(old), F.lit(False)) if old is not None else F.lit(False)
            rows.where(~late).write.mode("overwrite").parquet(f"{path}/kept/batch={number}")
            rows.where(late).write.mode("overwrite").parquet(f"{path}/late/batch={number}")
            mark = rows.agg(F.greatest(F.max(time) - F.expr(f"INTERVAL {delay}"), F.lit(old).cast("timestamp")).alias("mark"))
            mark.write.mode("overwrite").parquet(f"{path}/marks/batch={number}")
        finally:
            rows.unpersist()

    _each_batch(stream, write, "late", f"{path}/checkpoint")
    kept, late = (spark.read.schema(schema).parquet(f"{path}/{name}/*") for name in ("kept", "late"))
    return kept, late


def deduplicated(stream: DataFrame, event_id: str, time: str, delay: str, period: str, cols: Sequence[str]) -> DataFrame:
    """One row per event id. Copies carry the same time, hence the same window: an
    aggregate folds them inside each task before the shuffle, so a heap of
    copies of one event stays cheap."""
    row = F.struct(time, *cols)
    return (
        stream.withWatermark(time, delay)
        .groupBy(F.window(time, period), event_id)
        .agg(F.min(row).alias("_r"), F.count(F.lit(1)).alias("copies"))
        .select(event_id, "_r.*", "copies")
    )


# Status a model must be in -> (event that moves it, next status).
LIFECYCLE = {
    "": ("Completed", "PendingManualApproval"),
    "PendingManualApproval": ("Approved", "Approved"),
    "Approved": ("Deployed", "Deployed"),
}


def _chain(rules: Mapping[str, tuple[str, str]]) -> list[tuple[str, str, str]]:
    """(status, event, next status) in the order a model passes them."""
    out, current = [], ""
    while current in rules:
        out.append((current, *rules[current]))
        current = out[-1][2]
    return out


def earliest_moves(events: DataFrame, known: DataFrame, model: str, status: str, time: str,
                   rules: Mapping[str, tuple[str, str]] = LIFECYCLE) -> DataFrame:
    """The events that move models on: (model, status, time), at most one per model and rule.

    `known` has (model, _current, _since): what each model was moved to before, and when. For
    one status after the other, the earliest event that the status waits for and that is later than the
    model's last move is a minimum per model, folded in each task before the shuffle.
    """
    found = None
    for current, event, following in _chain(rules):
        wanted = lookup_join(events.where(F.col(status) == event).select(model, time), known, model)
        fits = (F.coalesce("_current", F.lit("")) == current) & (F.col("_since").isNull() | (F.col(time) > F.col("_since")))
        moved = wanted.where(fits).groupBy(model).agg(F.min(time).alias("_at"))
        step = moved.select(model, F.lit(event).alias(status), F.col("_at").alias(time))
        found = step if found is None else found.unionByName(step)
        after = moved.select(model, F.lit(following).alias("_next"), "_at")
        known = known.join(after, model, "full").select(
            model, F.coalesce("_next", "_current").alias("_current"), F.coalesce("_at", "_since").alias("_since"))
    return found


def moving_events(stream: DataFrame, model: str, status: str, time: str, rules: Mapping[str, tuple[str, str]] = LIFECYCLE,
                  buckets: int = 16) -> tuple[str, T.StructType]:
    """Write, batch by batch, the events that move a model on; returns path and schema. Within a
    batch, order of arrival does not matter.

    The last move of every model is kept in a latest view beside them: a batch looks up its own models in
    their buckets, never in earlier batches, so its cost does not grow with their number. A batch that is repeated
    replaces its own files, or is passed over if the view has taken it in already."""
    spark, path = stream.sparkSession, scratch_path(stream.sparkSession, "moving")
    schema = stream.select(model, status, time).schema
    following = F.create_map(*[F.lit(x) for _, event, nxt in _chain(rules) for x in (event, nxt)])
    state = T.StructType([schema[model], T.StructField("_current", T.StringType()), T.StructField("_since", schema[time].dataType)])
    view = LatestView(spark, f"{path}-state", state, [model], ["_since"], buckets)

    spark.createDataFrame([], schema).write.parquet(f"{path}/batch=0")

    def write(batch: DataFrame, number: int) -> None:
        taken = view.note()
        if taken is not None and int(taken) >= number:
            return
        rows = batch.select(model, status, time).where(F.col(status).isin([event for _, event, _ in _chain(rules)])).persist()
        try:
            earliest_moves(rows, view.lookup(rows.select(model)), model, status, time, rules).write.mode("overwrite").parquet(f"{path}/batch={number + 1}")
        finally:
            rows.unpersist()
        moved = spark.read.schema(schema).parquet(f"{path}/batch={number + 1}")
        last = latest_by(moved, [model], [time])
        view.merge(last.select(model, following[F.col(status)].alias("_current"), F.col(time).alias("_since")), str(number))

    _each_batch(stream, write, "moving")
    return path, schema


def transitions(events: DataFrame, model: str, status: str, time: str, rules: Mapping[str, tuple[str, str]] = LIFECYCLE) -> DataFrame:
    """Keyed state function: emits (model, from_status, to_status, moved_at) for every valid move
    and ignores the rest. Feed it `moving_events`: a few rows per model, however many came in."""
    kind = events.schema[model].dataType.simpleString()

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        current = state.get[0] if state.exists else ""
        rows = pd.concat(list(batches)).sort_values([time, status])
        moves = []
        for _, row in rows.iterrows():
            event, following = rules.get(current, (None, None))
            if row[status] == event:
                moves.append((key[0], current, following, row[time]))
                current = following
        state.update((current,))
        if moves:
            yield pd.DataFrame(moves, columns=[model, "from_status", "to_status", "moved_at"])

    return events.groupBy(model).applyInPandasWithState(
        step,
        f"{model} {kind}, from_status string, to_status string, moved_at timestamp",
        "current string",
        "append",
        GroupStateTimeout.NoTimeout,
    )


def notifications(moves: DataFrame, model: str) -> DataFrame:
    """Message row per state change (delivery is not built)."""
    text = F.format_string("Model %s: %s -> %s", F.col(model).cast("string"),
                           F.when(F.col("from_status") == "", "new").otherwise(F.col("from_status")), "to_status")
    return moves.select(model, "moved_at", text.alias("message"))


def outcome_salts(outcomes: DataFrame, key: str, parts: int = 256) -> DataFrame:
    """(key, salts) of the heavy keys of past outcomes: a key with a share s of all rows gets
    s * parts salts. Heavy keys are bounded in number, so the table may be broadcast."""
    counts = outcomes.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    return heavy_keys(counts).select(key, F.greatest(F.ceil(F.col("n") * parts / total).cast("int"), F.lit(1)).alias("salts"))


def joined_outcomes(predictions: DataFrame, outcomes: DataFrame, key: str, predicted_at: str, observed_at: str,
                    outcome_id: Column, within: str, delay: str, salts: DataFrame | None = None) -> DataFrame:
    """Predictions joined to the outcomes of the same request seen within a bound, as a stream of the joined rows.

    A request may have many outcomes. `salts` (key, salts) names the hot ones: their
    outcomes are dealt by id, and only their predictions are kept once per salt.

    Both streams are run to their end here, batch by batch: the rows of a batch are stored, and joined as tables with each other and with those stored rows that may
    still find a partner, so that no row waits in the memory of a task. As in a stateful join, a row comes too late if its time is not after the
    watermark: the newest time of the stream that is behind less `delay`, by all batches but the last two.
    """
    if salts is None:
        salts = predictions.sparkSession.createDataFrame([], f"{key} {predictions.schema[key].dataType.simpleString()}, salts int")
    salts = F.broadcast(salts)
    count = F.coalesce("salts", F.lit(1))
    spark, path = predictions.sparkSession, scratch_path(predictions.sparkSession, "outcomes")
    sides = {"_p": (predictions, predicted_at), "_o": (outcomes, observed_at)}
    kinds = {side: F.struct(*[F.col(f"`{c}`") for c in df.columns]) for side, (df, _) in sides.items()}
    none = {side: F.lit(None).cast(T.StructType(df.schema.fields)) for side, (df, _) in sides.items()}
    both = predictions.select(kinds["_p"].alias("_p"), none["_o"].alias("_o")).unionByName(outcomes.select(none["_p"].alias("_p"), kinds["_o"].alias("_o")))
    newest: list[dict[str, int | None]] = []  # by batch, micros of each side

    def write(batch: DataFrame, number: int) -> None:
        del newest[number:]
        ends = [max((x[side] for x in newest[: max(number - 1, 0)] if x[side] is not None), default=None) for side in sides]
        mark = None if None in ends else F.timestamp_micros(F.lit(min(ends))) - F.expr(f"INTERVAL {delay}")
        newest.append({})
        for side, (df, time) in sides.items():
            rows = batch.where(F.col(side).isNotNull()).select(f"{side}.*")
            (rows if mark is None else rows.where(F.col(time) > mark)).write.mode("overwrite").parquet(f"{path}/{side}/batch={number}")
            newest[number][side] = spark.read.schema(df.schema).parquet(f"{path}/{side}/batch={number}").agg(F.max(F.unix_micros(F.col(time).cast("timestamp")))).first()[0]

        def stored(side: str) -> DataFrame:
            df, time = sides[side]
            read = lambda some: spark.read.schema(df.schema).parquet(*[f"{path}/{side}/batch={k}" for k in some])
            now = read([number]).withColumn(f"{side}_new", F.lit(True))
            if not number:
                return now
            before = read(range(number)).withColumn(f"{side}_new", F.lit(False))
            if mark is not None:  # earlier predictions are waited for until `within` has passed, outcomes wait for nothing earlier
                before = before.where(F.col(time) >= (mark - F.expr(f"INTERVAL {within}") if side == "_p" else mark))
            return now.unionByName(before)

        left = stored("_p").join(salts, key, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), count - 1))).drop("salts")
        right = stored("_o").join(salts, key, "left").withColumn("_rsalt", F.pmod(F.xxhash64(outcome_id), count).cast("int")).drop("salts").withColumnRenamed(key, "_key")
        on = (
            (F.col(key) == F.col("_key")) & (F.col("_salt") == F.col("_rsalt"))
            & (F.col(observed_at) >= F.col(predicted_at))
            & (F.col(observed_at) <= F.col(predicted_at) + F.expr(f"INTERVAL {within}"))
            & (F.col("_p_new") | F.col("_o_new"))
        )
        left.join(right, on).select(*columns).write.mode("overwrite").parquet(f"{path}/joined/batch={number}")

    columns = [key, *[c for c in predictions.columns if c != key], *[c for c in outcomes.columns if c != key]]
    fields = {**{f.name: f for f in outcomes.schema.fields}, **{f.name: f for f in predictions.schema.fields}}
    schema = T.StructType([T.StructField(c, fields[c].dataType) for c in columns])
    spark.createDataFrame([], schema).write.parquet(f"{path}/joined/batch=none")
    _each_batch(both, write, "outcomes")
    return arriving(spark, f"{path}/joined/*", schema)
