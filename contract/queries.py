"""Every operator as a query over the driver's tables."""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from contract import bindings as B
from swishline.operators import analytics as A
from swishline.operators import evaluation as E
from swishline.operators import model as M
from swishline.operators import nodes as N
from swishline.operators import plays as P
from swishline.operators import sampling as L
from swishline.operators import scoring as X
from swishline.operators import skill as K
from swishline.operators.lookup import skill_lookup_serve, skill_lookup_train
from swishline.plans import retrain as R
from swishline.schemas import EVENT_FIELDS, FEATURES, PLAYS, SHOT_TYPES, TELEMETRY_COLUMNS
from swishline.sources import artifacts, events, telemetry
from swishline.sources import plays as plays_csv
from swishline.sources.scratch import scratch_dir, written
from swishline.streaming import enrich, live

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

ONCE = {"availableNow": True}


def query(fn: Query) -> Query:
    """Register under the function's name, without the mark that avoids a clash."""
    QUERIES[fn.__name__.rstrip("_")] = fn
    return fn


def per_row(name: str, step: Callable[[DataFrame], DataFrame], source: Query, *columns: str) -> None:
    """Register an operator that adds columns to, or filters, the rows of a binding."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return step(source(spark, sf_dir)).select(*columns)

    QUERIES[name] = run


def report(
    name: str, step: Callable[[DataFrame], DataFrame], source: Query, *rounded: str
) -> None:
    """Register a report; the named double columns are rounded to compare."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return to_compare(step(source(spark, sf_dir)), *rounded)

    QUERIES[name] = run


def to_compare(df: DataFrame, *rounded: str) -> DataFrame:
    """Doubles to 9 places (sums depend on order); times without a zone."""
    for name in rounded:
        df = df.withColumn(name, F.round(name, 9))
    for name, kind in df.dtypes:
        if kind == "timestamp":
            df = df.withColumn(name, F.col(f"`{name}`").cast("timestamp_ntz"))
    return df


def described(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.combine_description(P.filter_shots(B.plays(spark, sf_dir)))


def totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.player_totals(B.plays(spark, sf_dir))


def split_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.train_test_split(B.scored(spark, sf_dir), F.col("play_id"))


def latest_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dashboard's sample, behind one exchange that its readers share."""
    return L.latest_n(B.telemetry(spark, sf_dir)).repartition("shot_distance")


# ------------------------------------------------------------ filters and columns

PLAY_COLUMNS = ("play_id", *PLAYS.fieldNames())
FLAGS = tuple(SHOT_TYPES)

per_row("filter_shots", P.filter_shots, B.plays, *PLAY_COLUMNS)
per_row("combine_description", P.combine_description, B.plays, "play_id", "description")
per_row("extract_distance", P.extract_distance, described, "play_id", "shot_distance")
per_row("require_distance", P.shots, B.plays, "play_id", "shot_distance")
per_row("result_label", P.result_label, B.shots, "play_id", "result")
per_row("shot_type_flags", P.shot_type_flags, B.shots, "play_id", *FLAGS)
per_row("seconds_remaining", P.seconds_remaining, B.plays, "play_id", "seconds_remaining")
per_row("is_three", P.is_three, B.shots, "play_id", "is_three")
per_row("is_home", P.is_home, B.plays, "play_id", "is_home")
per_row("event_defaults", P.event_defaults, B.plays, "play_id", "game_id", "player", "period")
per_row("shot_type_label", lambda df: P.shot_type_label(P.described_shots(df)), B.plays,
        "play_id", "shot_type")
per_row("heuristic_xp", X.heuristic_xp, B.shots, "play_id", "expected_points")
per_row("shot_grade", lambda df: X.shot_grade(X.expected_points(df)), B.scored,
        "play_id", "shot_grade")
per_row("shot_zone", A.shot_zone, B.telemetry, "shot_id", "zone")
per_row("predict_label", E.predict_label, B.scored, "play_id", "prediction")
per_row("train_test_split", lambda df: L.train_test_split(df, F.col("play_id")), B.shots,
        "play_id", "split")


@query
def expected_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = X.expected_points(B.scored(spark, sf_dir))
    return to_compare(rows.select("play_id", "expected_points"), "expected_points")


@query
def shot_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = A.shot_position(B.telemetry(spark, sf_dir))
    return rows.select("shot_id", _plain("x").alias("x"), _plain("y").alias("y"))


def _plain(name: str) -> Column:
    """Six places, and no negative zero."""
    value = F.round(name, 6)
    return F.when(value == 0, F.lit(0.0)).otherwise(value)


@query
def build_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir, "play_id")


@query
def event_field_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages that lack whatever the raw play lacks, and most fields altogether."""
    rows = P.extract_distance(described(spark, sf_dir))
    sparse = F.struct(
        "game_id",
        F.col("player1_name").alias("player"),
        F.col("shot_distance").alias("distance"),
        "period",
    )
    messages = rows.select("play_id", F.to_json(sparse).alias("value"))
    filled = P.event_field_defaults(P.readable(P.decode_events(messages)))
    rated = skill_lookup_serve(filled, None)
    flags = ("is_three", *FLAGS, "is_home")
    return rated.select(
        "play_id", "game_id", "player", "distance", "period", "seconds_remaining", *flags,
        "player_skill_rating",
    )


@query
def feature_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    plays = B.plays(spark, sf_dir)
    return R.feature_rows(plays, R.rated_players(plays), ("play_id",))


@query
def feature_rows_training(spark: SparkSession, sf_dir: str) -> DataFrame:
    plays = B.plays(spark, sf_dir)
    rows = R.feature_rows(plays, R.rated_players(plays), ("play_id",), legacy_training=True)
    return to_compare(rows, "player_skill_rating")


# ---------------------------------------------------------------------- look-ups


@query
def skill_lookup_train_(spark: SparkSession, sf_dir: str) -> DataFrame:
    plays = B.plays(spark, sf_dir)
    ratings = R.rated_players(plays)
    rows = P.raw_inputs(plays).select("play_id", "player")
    rated = skill_lookup_train(rows, ratings, K.league_value(ratings.frame))
    return to_compare(rated, "player_skill_rating")


@query
def skill_lookup_serve_(spark: SparkSession, sf_dir: str) -> DataFrame:
    plays = B.plays(spark, sf_dir)
    rows = P.served_inputs(plays).select("play_id", "player")
    return skill_lookup_serve(rows, R.rated_players(plays))


# ----------------------------------------------------------------- reports, ratings

report("total_shots", A.total_shots, B.telemetry)
report("avg_xp", A.avg_xp, B.telemetry, "avg_xp")
report("grade_distribution", A.grade_distribution, B.telemetry, "percent")
report("player_leaderboard", A.player_leaderboard, B.telemetry, "avg_xp")
report("zone_stats", A.zone_stats, B.telemetry, "avg_xp")
report("recent_activity", A.recent_activity, B.telemetry)
report("shots_per_minute", A.shots_per_minute, B.telemetry)
report("premium_pct", A.premium_pct, B.telemetry, "premium_pct")
report("three_point_pct", A.three_point_pct, B.telemetry, "three_point_pct")
report("distance_histogram", A.distance_histogram, latest_sample)
report("distance_histogram_all", A.distance_histogram, B.telemetry)
report("xp_by_distance", A.xp_by_distance, latest_sample, "avg_xp")
report("xp_by_distance_all", A.xp_by_distance, B.telemetry, "avg_xp")
report("dashboard_snapshot", A.dashboard_snapshot, B.telemetry,
       "avg_xp", "premium_pct", "three_point_pct")
report("player_totals", K.player_totals, B.plays)
report("league_avg", K.league_avg, totals, "league_avg")
report("player_skill", K.player_skill, totals)
report("class_balance", E.class_balance, split_scored,
       "made_rate", "missed_rate", "scale_pos_weight")
report("eval_accuracy", E.eval_accuracy, B.scored, "accuracy")
report("eval_logloss", E.eval_logloss, B.scored, "logloss")
report("eval_brier", E.eval_brier, B.scored, "brier")
report("eval_auc", E.eval_auc, B.scored, "auc")
report("latest_n", lambda df: L.latest_n(df).select(*TELEMETRY_COLUMNS), B.telemetry)
report("sample_n", lambda df: L.sample_n(df).select(*TELEMETRY_COLUMNS), B.telemetry)
report("recent_shots", L.recent_shots, B.telemetry)

# -------------------------------------------------------------- sources and sinks


def _events(spark: SparkSession, sf_dir: str, *keep: str) -> DataFrame:
    return P.build_event(B.plays(spark, sf_dir), F.col("created_at"), keep)


def _files(spark: SparkSession) -> events.Transport:
    return events.Transport("files", scratch_dir(spark, "stream"))


PUBLISHED_FILES = 8


def _published(spark: SparkSession, sf_dir: str) -> events.Transport:
    """All shots as messages in several files, so that a bounded stream has several batches."""
    transport = _files(spark)
    events.publish_events(_events(spark, sf_dir).repartition(PUBLISHED_FILES), transport)
    return transport


def _halves(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Events of the first and of the second half of the time span."""
    rows = _events(spark, sf_dir)
    halfway = rows.agg((F.min("timestamp") + F.max("timestamp")) / 2).scalar()
    return rows.where(F.col("timestamp") < halfway), rows.where(F.col("timestamp") >= halfway)


def _typed_events(readable: DataFrame) -> DataFrame:
    whole = [f for f in EVENT_FIELDS if f not in ("game_id", "player", "result", "timestamp")]
    return readable.select(
        *[F.col(f).cast("int").alias(f) if f in whole else F.col(f) for f in EVENT_FIELDS]
    )


def _drain(stream: DataFrame, path: str) -> None:
    """Run a stream over what is there, storing its rows below ``path``."""
    run = stream.writeStream.format("parquet").option("checkpointLocation", f"{path}-offsets")
    run.trigger(availableNow=True).start(path).awaitTermination()


# quotes, commas and backslashes, as a description may hold them
AWKWARD = ' "alley, oop" \\"'


@query
def scan_plays(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "plays-csv")
    rows = B.plays(spark, sf_dir).select(*PLAY_COLUMNS)
    said = F.concat("homedescription", F.lit(AWKWARD))
    plays_csv.write_plays(rows.withColumn("homedescription", said), path)
    rows = plays_csv.scan_plays(spark, path, extra=("play_id",))
    return rows.withColumn("play_id", F.col("play_id").cast("bigint"))


@query
def publish_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = events.read_messages(spark, _published(spark, sf_dir))
    return _typed_events(P.readable(P.decode_events(messages)))


@query
def subscribe_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shots arrive as events, all other plays as text that is no JSON."""
    transport = _published(spark, sf_dir)
    others = P.combine_description(B.plays(spark, sf_dir).where("eventmsgtype NOT IN (1, 2)"))
    others.select(F.col("description").alias("value")).write.mode("append").text(transport.path)

    path = scratch_dir(spark, "decoded")
    _drain(P.decode_events(events.subscribe_events(spark, transport)), path)
    decoded = spark.read.parquet(path)
    good = _typed_events(P.readable(decoded)).withColumn("rejected", F.lit(None).cast("string"))
    bad = P.unreadable(decoded).select(
        *[F.lit(None).cast(kind).alias(name) for name, kind in good.dtypes if name != "rejected"],
        F.col("value").alias("rejected"),
    )
    return good.unionByName(bad)


@query
def replay_bounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One file per trigger: every event, and the number of batches that it took."""
    path = scratch_dir(spark, "replayed")
    messages = events.subscribe_events(spark, _published(spark, sf_dir), max_per_trigger=1)

    def store(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    run = P.readable(P.decode_events(messages)).writeStream.foreachBatch(store)
    run = run.option("checkpointLocation", f"{path}-offsets").trigger(availableNow=True)
    run.start().awaitTermination()
    rows = spark.read.option("basePath", path).parquet(path)
    batches = rows.agg(F.count_distinct("batch_id")).scalar()
    return _typed_events(rows).withColumn("batches", batches)


def _stored_telemetry(spark: SparkSession, sf_dir: str) -> str:
    """Two batches, the second of them run twice as after a crash."""
    path = scratch_dir(spark, "telemetry")
    rows = B.telemetry(spark, sf_dir)
    three = F.col("shot_distance") > 23
    telemetry.append_telemetry(rows.where(~three), path, 0)
    telemetry.append_telemetry(rows.where(three), path, 1)
    telemetry.append_telemetry(rows.where(three), path, 1)
    return path


@query
def append_telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _stored_telemetry(spark, sf_dir)
    return to_compare(telemetry.read_telemetry(spark, path))


@query
def scan_telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "telemetry")
    telemetry.append_telemetry(B.telemetry(spark, sf_dir), path, 0)
    return to_compare(telemetry.scan_telemetry(telemetry.read_telemetry(spark, path)))


@query
def skill_artifact(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_dir(spark, "artifacts")
    artifacts.publish_ratings(K.player_skill(totals(spark, sf_dir)), root)
    _, table = artifacts.load_ratings(spark, [f"{root}-absent", root])
    return table.frame.select("player", "rating")


@query
def model_artifact(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_dir(spark, "artifacts")
    train, test = _train_test(spark, sf_dir)
    fitted = M.train_logistic(train)
    artifacts.publish_model(spark, fitted, root)
    _, model = artifacts.load_model(spark, [f"{root}-absent", root])
    before, after = _probabilities(test, fitted), _probabilities(test, model)
    same = F.col("before.p") == F.col("after.p")
    joined = before.alias("before").join(after.alias("after"), "shot_key")
    return joined.select("shot_key", same.alias("same"))


# ------------------------------------------------------------------------ models


def _probabilities(rows: DataFrame, model: PipelineModel) -> DataFrame:
    return X.score_shots(rows, model).select("shot_key", "p")


def _train_test(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    plays = B.plays(spark, sf_dir)
    rows = R.split_features(plays, R.rated_players(plays), F.col("play_id"))
    return rows.where("split = 'train'"), rows.where("split = 'test'")


@dataclass(frozen=True)
class Trained:
    """One full training run over a table folder, which all model queries look at."""

    run: R.Retrained
    root: str
    features: DataFrame


_TRAINED: dict[tuple[str, str], Trained] = {}


def trained(spark: SparkSession, sf_dir: str) -> Trained:
    """The whole job with its default 100 rounds, once per session and folder."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _TRAINED:
        root = scratch_dir(spark, "artifacts")
        done = R.retrain(spark, B.plays(spark, sf_dir), root, F.col("play_id"))
        _TRAINED[key] = Trained(done, root, done.features)
    return _TRAINED[key]


PLACES = 1e-9


@query
def train_boosted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every round up to the most that may be fitted, and whether it is as it has to be.

    Of the rounds that the model keeps, the held-out loss is that of its node table, walked
    apart from the library, and no other kept one is as low as the last. Rounds after
    them bring no gain until patience runs out. Rounds that were not fitted lie beyond that.
    """
    done = trained(spark, sf_dir)
    nodes = N.model_nodes(spark, done.run.model)
    held_out = done.features.where("split = 'test'")
    walked = {r["round"]: r["loss"] for r in N.losses_by_round(held_out, nodes, "shot_key").collect()}
    return spark.createDataFrame(
        judged_rounds(done.run.losses, walked, M.Boosting()), "round int, as_walked boolean"
    )


def judged_rounds(
    losses: list[float], walked: dict[int, float], settings: M.Boosting
) -> list[tuple[int, bool]]:
    """By round: whether the told losses agree with those of a model that keeps ``walked``."""
    kept = max(walked)
    least = walked[kept]
    out_of_patience = kept + settings.patience
    rows = []
    for n in range(1, settings.rounds + 1):
        if n <= kept:
            right = n in walked and abs(losses[n - 1] - walked[n]) < PLACES
            right = right and (n == kept or walked[n] > least)
        elif n <= len(losses):
            right = n > out_of_patience or losses[n - 1] >= least
        else:
            right = n > out_of_patience
        rows.append((n, right))
    return rows


@query
def train_logistic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inputs at which the weighted loss is flat: its slope, per row and scale, is near 0."""
    train, _ = _train_test(spark, sf_dir)
    model = M.train_logistic(train)
    weight = M.positive_weight(train)
    rows = X.score_shots(train, model)
    pull = F.when(F.col("label") == 1, weight * (F.col("p") - 1)).otherwise(F.col("p"))
    slopes = rows.agg(
        *[
            (F.abs(F.avg(pull * F.col(f))) <= 1e-3 * (F.stddev(f) + 1e-3)).alias(f)
            for f in FEATURES
        ]
    )
    return slopes.unpivot([], FEATURES, "feature", "flat")


@query
def score_shots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether each shot's probability is that of the model's node table, to 9 places."""
    done = trained(spark, sf_dir)
    nodes = N.model_nodes(spark, done.run.model)
    return as_walked(_probabilities(done.features, done.run.model), done.features, nodes)


def as_walked(scored: DataFrame, features: DataFrame, nodes: DataFrame) -> DataFrame:
    told, walked = scored.alias("told"), N.walked(features, nodes, "shot_key").alias("walked")
    same = F.abs(F.col("told.p") - F.col("walked.p")) < PLACES
    return told.join(walked, "shot_key", "left").select(
        "shot_key", F.coalesce(same, F.lit(False)).alias("as_walked")
    )


@query
def feature_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names, and whether the weights are shares that add up to 1, largest first."""
    rows = M.feature_importance(spark, trained(spark, sf_dir).run.model).collect()
    weights = [r["importance"] for r in rows]
    right = abs(sum(weights) - 1) < 1e-9 and weights == sorted(weights, reverse=True)
    return spark.createDataFrame(
        [(r["feature"], right and r["importance"] >= 0) for r in rows],
        "feature string, share boolean",
    )


@query
def what_if_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scenarios by the model that the table's shots have taught, against a walk of its
    nodes; and those of the logistic model against its coefficients."""
    done = trained(spark, sf_dir)
    logistic = M.train_logistic(done.features.where("split = 'train'"))
    told = M.what_if_scores(spark, done.run.model).alias("b").join(
        M.what_if_scores(spark, logistic).alias("l"), "scenario"
    )
    rows = M.scenario_rows(spark)
    walked = N.walked(rows, N.model_nodes(spark, done.run.model), "scenario").alias("w")
    weighed = N.weighed(rows, N.model_coefficients(spark, logistic), "scenario").alias("c")
    return told.join(walked, "scenario").join(weighed, "scenario").select(
        "scenario",
        (F.abs(F.col("b.p") - F.col("w.p")) < PLACES).alias("as_walked"),
        (F.abs(F.col("l.p") - F.col("c.p")) < PLACES).alias("as_weighed"),
    )


@query
def retrain_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact counts of both parts; whether the metrics told are those of the probabilities
    that the stored model's node table gives; and whether the model has learnt: over the
    train part its weighted loss is below that of the part's made rate alone. The labels
    follow no rule, so over held-out rows no such bound holds."""
    done = trained(spark, sf_dir)
    counts = done.features.groupBy("split").agg(
        F.count(F.lit(1)).alias("n"), F.sum("label").cast("bigint").alias("made")
    )
    version, _ = artifacts.load_model(spark, [done.root])
    nodes = N.stored_nodes(spark, version.location)
    walked = N.walked(done.features, nodes, "shot_key")
    scored = written(
        done.features.select("shot_key", "split", "label").join(walked, "shot_key"), "walked"
    )
    again = scored.where("split = 'test'")
    told = done.run.metrics.first()
    right = all(
        abs(told[name] - report(again).first()[0]) < PLACES
        for name, report in (
            ("accuracy", E.eval_accuracy),
            ("logloss", E.eval_logloss),
            ("brier", E.eval_brier),
            ("auc", E.eval_auc),
        )
    )
    return counts.withColumns(
        {
            "metrics_right": F.lit(right),
            "learnt": F.lit(has_learnt(scored.where("split = 'train'"))),
        }
    )


def has_learnt(train: DataFrame) -> bool:
    """Whether the class-weighted loss is below that of the weighted made rate, which is 1/2."""
    weight = F.when(F.col("label") == 1, M.positive_weight(train)).otherwise(1.0)
    own = F.when(F.col("label") == 1, F.col("p")).otherwise(1 - F.col("p"))
    loss = F.sum(-weight * F.ln(own)) / F.sum(weight)
    return train.agg(loss).first()[0] < math.log(2) - 1e-6


# --------------------------------------------------------------------- streaming


def _enriched(
    spark: SparkSession,
    transport: events.Transport,
    scorer: enrich.Scorer,
    checkpoint: str | None = None,
) -> str:
    """Score what has been published; telemetry gets the event's time as its own."""
    path = scratch_dir(spark, "telemetry")
    enrich.stream_enrich(
        events.subscribe_events(spark, transport),
        scorer,
        path,
        f"{path}-rejects",
        checkpoint or f"{path}-offsets",
        created_at=X.event_time(),
        trigger=ONCE,
    ).awaitTermination()
    return path


@query
def stream_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ratings are there, a model is not: the heuristic makes the result exact."""
    root = scratch_dir(spark, "artifacts")
    artifacts.publish_ratings(K.player_skill(totals(spark, sf_dir)), root)
    path = _enriched(spark, _published(spark, sf_dir), enrich.Scorer(spark, [root]))
    return to_compare(telemetry.read_telemetry(spark, path).drop("shot_id"))


@query
def stream_enrich_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stream, scored by the published model and ratings, against the batch."""
    root = trained(spark, sf_dir).root
    transport, scorer = _published(spark, sf_dir), enrich.Scorer(spark, [root])
    stored = telemetry.read_telemetry(spark, _enriched(spark, transport, scorer))
    messages = P.readable(P.decode_events(events.read_messages(spark, transport)))
    batch = X.score_events(messages, scorer.model, scorer.ratings, X.event_time())
    return as_batch(stored, batch)


def as_batch(stored: DataFrame, batch: DataFrame) -> DataFrame:
    """Pairs of stored and batch rows of a shot by time, and whether all have equal scores.

    Equal messages share a shot_id: their pairs are counted, not made."""
    shots = ["shot_id", "event_time", "shot_distance"]
    score = F.struct("expected_points", "shot_grade")
    alike = [F.count(F.lit(1)).alias("n"), F.min(score).alias("low"), F.max(score).alias("high")]
    pairs = stored.groupBy(*shots).agg(*alike).alias("s").join(
        batch.groupBy(*shots).agg(*alike).alias("b"), shots
    )
    same = (
        (F.col("s.low") == F.col("b.low"))
        & (F.col("s.high") == F.col("b.high"))
        & (F.col("s.low") == F.col("s.high"))
    )
    return pairs.groupBy("event_time").agg(
        F.sum(F.col("s.n") * F.col("b.n")).alias("shots"), F.bool_and(same).alias("as_batch")
    ).withColumn("event_time", F.col("event_time").cast("timestamp_ntz"))


@query
def stream_hot_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second half of the events meets the first model, which comes after the first half."""
    root, checkpoint = scratch_dir(spark, "artifacts"), scratch_dir(spark, "offsets")
    scorer = enrich.Scorer(spark, [root], reload_seconds=-1)
    transport = _files(spark)
    parts = []
    for generation, half in enumerate(_halves(spark, sf_dir), 1):
        events.publish_events(half, transport)
        path = _enriched(spark, transport, scorer, checkpoint=checkpoint)
        rows = telemetry.read_telemetry(spark, path)
        # the heuristic knows two values only
        guessed = F.bool_and(F.col("expected_points").isin(1.0, 0.8)).alias("by_heuristic")
        counts = rows.agg(F.count(F.lit(1)).alias("shots"), guessed)
        parts.append(counts.withColumn("generation", F.lit(generation)))
        if generation == 1:
            train, _ = _train_test(spark, sf_dir)
            artifacts.publish_model(spark, M.train_logistic(train), root)
    return parts[0].unionByName(parts[1])


@query
def stream_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    scorer = enrich.Scorer(spark, [scratch_dir(spark, "no-artifacts")])
    path = _enriched(spark, _published(spark, sf_dir), scorer)
    rows = telemetry.read_telemetry(spark, path)
    return rows.select("game_id", "player_name", "shot_distance", "expected_points", "shot_grade")


@query
def stream_start_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grades of what a consumer sees that starts at the earliest or latest message.

    The first half of the time span is history when the second consumer starts.
    """
    history, news = _halves(spark, sf_dir)
    transport = _files(spark)
    events.publish_events(history, transport)
    checkpoint = scratch_dir(spark, "offsets")
    enrich.skip_history(events.subscribe_events(spark, transport), checkpoint)
    events.publish_events(news, transport)

    scorer = enrich.Scorer(spark, [scratch_dir(spark, "no-artifacts")])
    seen = {
        events.EARLIEST: _enriched(spark, transport, scorer),
        events.LATEST: _enriched(spark, transport, scorer, checkpoint=checkpoint),
    }
    parts = [
        telemetry.read_telemetry(spark, path)
        .groupBy(F.lit(start).alias("start_position"), "shot_grade")
        .agg(F.count(F.lit(1)).alias("shots"))
        for start, path in seen.items()
    ]
    return parts[0].unionByName(parts[1])


@query
def stream_shots_per_minute(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A replay of history in order of time, a file per micro-batch, at the default lateness."""
    path, transport = scratch_dir(spark, "minutes"), _files(spark)
    events.publish_history(_events(spark, sf_dir), transport, PUBLISHED_FILES)
    messages = events.subscribe_events(spark, transport, max_per_trigger=1)
    timed = P.readable(P.decode_events(messages)).withColumn("event_time", X.event_time())
    live.stream_shots_per_minute(timed, path, f"{path}-offsets", ONCE).awaitTermination()
    return to_compare(live.shots_per_minute_now(spark, path))


@query
def stream_running_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "totals")
    messages = events.subscribe_events(spark, _published(spark, sf_dir))
    scored = X.score_events(P.readable(P.decode_events(messages)), None, None, X.event_time())
    live.stream_running_totals(scored, path, f"{path}-offsets", ONCE).awaitTermination()
    now = live.running_totals_now(spark, path)
    none = F.lit(None).cast("double")
    parts = [
        live.headline(now).select(
            F.lit("all").alias("report"), F.lit("all").alias("item"),
            F.col("total_shots").alias("shots"), "avg_xp",
        ),
        live.grades(now).select(
            F.lit("grade").alias("report"), F.col("grade").alias("item"), "shots",
            none.alias("avg_xp"),
        ),
        live.zones(now).select(
            F.lit("zone").alias("report"), F.col("zone").alias("item"), "shots", "avg_xp"
        ),
    ]
    return to_compare(parts[0].unionByName(parts[1]).unionByName(parts[2]), "avg_xp")
