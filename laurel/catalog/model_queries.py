"""Checked queries of the modelling operators (ML)."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from laurel.catalog import bindings as b
from laurel.catalog.bindings import oracle
from laurel.catalog.registry import query
from laurel.modelling import models, splits
from laurel.operators import ranking, rollup
from laurel.session import broadcast_bounded, scratch_path

GROUP = ["week_start", "conference"]
WEEK = ["player_id", "teamid", "season", "week_start"]
STATS = ["points", "assists", "plus_minus", "minutes", "attempted", "made"]
RANKED = """
SELECT *, ROW_NUMBER() OVER (PARTITION BY week_start, conference ORDER BY score DESC, player_id) AS rank FROM b9"""


def rounded(*columns, digits=6):
    return [F.round(c, digits).alias(c) for c in columns]


def vectors(t):
    """B7: 64 columns v0..v63 with y = label 0 against the rest."""
    return t.embeddings.select(
        "vec_id",
        (F.col("label") == 0).cast("int").alias("y"),
        *[F.col("embedding")[i].cast("double").alias(f"v{i}") for i in range(64)],
    )


VECTORS = [f"v{i}" for i in range(64)]


def documents(t):
    """B7: labelled documents with their numbers and categories."""
    return t.labels.join(t.documents.select("doc_id", "n_chars", "lang", "source"), "doc_id").select(
        "doc_id", F.col("quality").alias("y"), "toxic", "n_chars", "lang", "source"
    )


def candidates(t):
    """Player-weeks as award candidates: label y, season and the numbers of the week.

    The player-weeks are stored first, so that each scan of the candidates reads them and shuffles nothing.
    """
    weeks = b.player_weeks_table(t)
    # One award per week and conference.
    won = broadcast_bounded(b.awards(t).select("player_id", "week_start", "conference", F.lit(1).alias("y")))
    return (
        weeks.join(b.conferences(t), "teamid")
        .join(won, ["player_id", "week_start", "conference"], "left")
        .fillna({"y": 0})
        .select(*WEEK, "conference", "y", *[F.col(s).cast("double").alias(s) for s in STATS])
    )


# Two numbers, then one 0/1 column per category value and one per column for unknown values.
@query(
    "ml_1",
    """
SELECT l.doc_id, l.quality AS y, CAST(2 + nl + 1 + ns + 1 AS INTEGER) AS size,
       CAST(l.toxic AS DOUBLE) AS toxic, CAST(d.n_chars AS DOUBLE) AS n_chars, CAST(2 AS DOUBLE) AS ones,
       CAST(2 + lang_code AS INTEGER) AS lang_at, CAST(2 + nl + 1 + source_code AS INTEGER) AS source_at
FROM labels l JOIN documents d ON l.doc_id = d.doc_id
JOIN (SELECT COUNT(DISTINCT lang) AS nl, COUNT(DISTINCT source) AS ns FROM labels JOIN documents USING (doc_id)) n ON TRUE
JOIN (SELECT lang, ROW_NUMBER() OVER (ORDER BY lang) - 1 AS lang_code
      FROM (SELECT DISTINCT lang FROM labels JOIN documents USING (doc_id)) q) a ON a.lang = d.lang
JOIN (SELECT source, ROW_NUMBER() OVER (ORDER BY source) - 1 AS source_code
      FROM (SELECT DISTINCT source FROM labels JOIN documents USING (doc_id)) q) s ON s.source = d.source""",
)
def ml_1(t):
    rows = models.assemble_features(documents(t), exclude=["doc_id", "y"], categories=["lang", "source"])
    v = vector_to_array("features").alias("v")
    ones = F.filter(F.sequence(F.lit(2), F.size("v") - 1), lambda i: F.get("v", i) == 1)
    return rows.select("doc_id", "y", v).select(
        "doc_id",
        "y",
        F.size("v").alias("size"),
        F.get("v", F.lit(0)).alias("toxic"),
        F.get("v", F.lit(1)).alias("n_chars"),
        F.size(ones).cast("double").alias("ones"),
        ones[0].alias("lang_at"),
        ones[1].alias("source_at"),
    )


SCALED = ("points", "assists", "plus_minus")


@query(
    "ml_2",
    oracle(
        "SELECT player_id, teamid, season, week_start, "
        + ", ".join(f"ROUND((p.{c} - m_{c}) / s_{c}, 6) AS {c}" for c in SCALED)
        + " FROM pw p JOIN (SELECT "
        + ", ".join(f"AVG({c}) AS m_{c}, STDDEV_POP({c}) AS s_{c}" for c in SCALED)
        + " FROM pw WHERE season < (SELECT MAX(season) FROM pw)) m ON TRUE WHERE season = (SELECT MAX(season) FROM pw)"
    ),
)
def ml_2(t):
    train, test = splits.season_split(b.player_weeks(t))
    _, scaled = splits.standardise(train, SCALED, test)
    return scaled.select(*WEEK, *rounded(*SCALED))


@query("ml_3")
def ml_3(t):
    variance = models.explained_variance(vectors(t), VECTORS)
    enough = models.components_for(variance, 0.8)
    return variance.withColumn("components_for_80_percent", enough.scalar())


@query(
    "ml_4",
    oracle("""
SELECT vec_id, CAST(CASE WHEN label = 0 THEN 1 ELSE 0 END AS INTEGER) AS y,
       CASE WHEN ROW_NUMBER() OVER (PARTITION BY label = 0 ORDER BY md5(CAST(vec_id AS VARCHAR)), vec_id)
                 <= FLOOR(COUNT(*) OVER (PARTITION BY label = 0) * 0.8) THEN 'train' ELSE 'test' END AS part
FROM embeddings"""),
)
def ml_4(t):
    rows = t.embeddings.select("vec_id", (F.col("label") == 0).cast("int").alias("y"))
    return splits.stratified_split(rows, "y", "vec_id", 0.8)


@query(
    "ml_5",
    oracle("""
SELECT CAST(ROW_NUMBER() OVER (ORDER BY season DESC) AS INTEGER) AS fold, season,
       CAST(SUM(n) OVER (ORDER BY season) - n AS BIGINT) AS train_rows, n AS validation_rows
FROM (SELECT season, COUNT(*) AS n FROM pw GROUP BY season) q ORDER BY fold LIMIT 5"""),
)
def ml_5(t):
    return splits.fold_sizes(b.player_weeks(t))


@query("ml_6")
def ml_6(t):
    rows = splits.stratified_split(vectors(t), "y", "vec_id")
    train, test = rows.where("part = 'train'").drop("part"), rows.where("part = 'test'").drop("part")
    train = models.class_weights(train, "y")
    stages = models.feature_stages(train, exclude=["vec_id", "y", "weight"], components=38)
    return models.score(models.fit(train, stages, models.logistic(max_iter=1000)), test).select(
        "vec_id", "y", "prediction", "score"
    )


# Boosting stops on the newest season of the training rows; `rounds` says where.
@query("ml_7")
def ml_7(t):
    train, test = splits.season_split(candidates(t))
    held = train.agg(F.max("season").alias("s")).scalar()
    train = models.class_weights(train, "y").withColumn("held", F.col("season") == held)
    stages = models.feature_stages(train.select(*STATS), exclude=(), scale=False)
    model = models.fit(train, stages, models.boosted(rounds=500, depth=5, held="held", tolerance=0.001))
    scored = models.score(model, test).withColumn("rounds", F.lit(model.stages[-1].getNumTrees))
    return scored.select(*WEEK, "conference", "y", "score", "rounds")


@query("ml_8")
def ml_8(t):
    train, test = splits.season_split(candidates(t))
    train, test = splits.standardise(train, STATS, test)
    weights = models.fit_pairwise(train, GROUP, STATS, max_iter=100)
    return models.linear_score(test, weights).select(*WEEK, "conference", "y", "score")


# Top-1 of the boosted ranker beside the linear one on the five newest seasons; folds are fitted side by side.
@query("ml_8_trees")
def ml_8_trees(t):
    rows = candidates(t)

    def fold(season, train, validation):
        def run():
            held = train.agg(F.max("season")).first()[0]
            marked = train.withColumn("held", F.col("season") == held)
            trees = models.fit_ranking_trees(marked, GROUP, STATS, held="held")
            scaled, scaled_validation = splits.standardise(train, STATS, validation)
            weights = models.fit_pairwise(scaled, GROUP, STATS, max_iter=100)
            found = []
            for ranker, scored, rounds in (
                ("trees", trees.score(validation), len(trees.trees)),
                ("linear", models.linear_score(scaled_validation, weights), None),
            ):
                groups, rate = ranking.hit_rates(scored, GROUP, "player_id", (1,)).first()
                found.append((season, ranker, groups, rate, rounds))
            return found

        return run

    folds = splits.season_folds(rows, 5)
    found = models.fit_side_by_side([fold(*f) for f in folds if not f[1].isEmpty()], most=5)
    schema = "season int, ranker string, groups bigint, top_1_hit_rate double, rounds int"
    return t.spark.createDataFrame([x for one in found for x in one], schema)


# The oracle forms the pairs; a fifth of a point is lost per pair that is not 30 apart.
@query(
    "ml_9",
    oracle("""
SELECT COUNT(*) AS pairs, ROUND(AVG(GREATEST(0, 30 - (w.score - l.score))), 6) AS margin_loss
FROM b9 w JOIN b9 l ON w.week_start = l.week_start AND w.conference = l.conference
WHERE w.y = 1 AND l.y = 0"""),
)
def ml_9(t):
    return ranking.margin_loss(b.labelled_weeks(t), GROUP, margin=30.0).select("pairs", *rounded("margin_loss"))


HITS = ", ".join(
    f"ROUND(AVG(CASE WHEN rank <= {k} THEN 1 ELSE 0 END), 6) AS top_{k}_hit_rate" for k in (1, 3, 5, 10)
)
HIT_COLUMNS = [f"top_{k}_hit_rate" for k in (1, 3, 5, 10)]


@query(
    "ml_10",
    oracle(
        f"SELECT 'skipped' AS empty_groups, COUNT(*) AS groups, {HITS} FROM ranked WHERE y = 1 UNION ALL "
        f"SELECT 'missed', COUNT(*), {HITS} FROM (SELECT week_start, conference, "
        "MIN(CASE WHEN y = 1 THEN rank END) AS rank FROM ranked2 GROUP BY 1, 2) q",
        ranked=RANKED,
        ranked2="""
SELECT week_start, conference, CASE WHEN player_id % 2 = 0 THEN y ELSE 0 END AS y,
       ROW_NUMBER() OVER (PARTITION BY week_start, conference ORDER BY score DESC, player_id) AS rank FROM b9""",
    ),
)
def ml_10(t):
    rows = b.labelled_weeks(t)
    half = rows.withColumn("y", F.when(F.col("player_id") % 2 == 0, F.col("y")).otherwise(0))
    skipped = ranking.hit_rates(rows, GROUP, "player_id")
    missed = ranking.hit_rates(half, GROUP, "player_id", skip_groups_without_winner=False)
    both = skipped.withColumn("empty_groups", F.lit("skipped")).unionByName(
        missed.withColumn("empty_groups", F.lit("missed"))
    )
    return both.select("empty_groups", "groups", *rounded(*HIT_COLUMNS))


@query(
    "ml_11",
    oracle(
        """
SELECT 'best' AS statistic, CAST(MIN(rank) AS DOUBLE) AS value FROM ranked WHERE y = 1
UNION ALL SELECT 'worst', MAX(rank) FROM ranked WHERE y = 1
UNION ALL SELECT 'mean', ROUND(AVG(rank), 6) FROM ranked WHERE y = 1"""
        + "".join(
            f" UNION ALL SELECT 'p{p}', ROUND(quantile_cont(rank, {p / 100}), 6) FROM ranked WHERE y = 1"
            for p in (10, 25, 50, 75, 90)
        ),
        ranked=RANKED,
    ),
)
def ml_11(t):
    ranks = ranking.winner_ranks(b.labelled_weeks(t), GROUP, "player_id")
    return ranking.rank_summary(ranks).select("statistic", *rounded("value"))


# Winner of each group beside the predicted one, and the five best candidates in rank order.
@query(
    "ml_11_predictions",
    oracle(
        """
SELECT w.week_start, w.conference, w.player_id AS actual_winner, w.rank AS winner_rank, p.player_id AS predicted_winner, top_five
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY week_start, conference ORDER BY rank) AS first_winner FROM ranked WHERE y = 1) w
JOIN ranked p ON p.week_start = w.week_start AND p.conference = w.conference AND p.rank = 1
JOIN (SELECT week_start, conference, string_agg(CAST(player_id AS VARCHAR), ',' ORDER BY rank) AS top_five
      FROM ranked WHERE rank <= 5 GROUP BY week_start, conference) t ON t.week_start = w.week_start AND t.conference = w.conference
WHERE w.first_winner = 1""",
        ranked=RANKED,
    ),
)
def ml_11_predictions(t):
    rows = b.labelled_weeks(t)
    order = [F.desc("score"), F.asc("player_id")]
    best = ranking.top_candidates(rows, GROUP, order, ["player_id"], k=5)
    best = best.select(*GROUP, F.array_join(F.col("top.player_id").cast("array<string>"), ",").alias("top_five"))
    found = ranking.predictions(rows, GROUP, "player_id").join(best, GROUP)
    return found.withColumn("winner_rank", F.col("winner_rank").cast("bigint"))


CONFUSION = """
SELECT CASE WHEN y = 1 THEN 1 ELSE 0 END AS y, CASE WHEN score >= 20 THEN 1 ELSE 0 END AS p, score FROM b9"""


@query(
    "ml_12",
    oracle(
        """
SELECT tp, fp, fn, tn, ROUND((tp + tn) / (tp + fp + fn + tn), 6) AS accuracy, ROUND(tp / (tp + fp), 6) AS precision,
       ROUND(tp / (tp + fn), 6) AS recall, ROUND(2 * tp / (2 * tp + fp + fn), 6) AS f1, ROUND(auc, 6) AS auc
FROM (SELECT COUNT(*) FILTER (y = 1 AND p = 1) AS tp, COUNT(*) FILTER (y = 0 AND p = 1) AS fp,
             COUNT(*) FILTER (y = 1 AND p = 0) AS fn, COUNT(*) FILTER (y = 0 AND p = 0) AS tn FROM outcome) c
JOIN (SELECT (SUM(CASE WHEN y = 1 THEN r END) - SUM(y) * (SUM(y) + 1) / 2) / (SUM(y) * SUM(1 - y)) AS auc
      FROM (SELECT y, RANK() OVER (ORDER BY score) + (COUNT(*) OVER (PARTITION BY score) - 1) / 2 AS r
            FROM outcome) q) a ON TRUE""",
        outcome=CONFUSION,
    ),
)
def ml_12(t):
    rows = b.labelled_weeks(t).withColumn("p", (F.col("score") >= 20).cast("int"))
    auc = ranking.roc_auc(rows, "score", "y").scalar()
    return (
        ranking.confusion(rows, "y", "p")
        .withColumn("auc", auc)
        .select("tp", "fp", "fn", "tn", *rounded("accuracy", "precision", "recall", "f1", "auc"))
    )


MODELS = {"by_assists": "score", "by_points": "points / 10", "by_both": "points / 20 + score / 2"}


@query(
    "ml_13",
    oracle(
        " UNION ALL ".join(
            f"SELECT '{name}' AS model, COUNT(*) AS groups, ROUND(AVG(CASE WHEN rank <= 1 THEN 1 ELSE 0 END), 6) AS top_1_hit_rate "
            f"FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY week_start, conference ORDER BY {score} DESC, player_id) AS rank FROM b9) q WHERE y = 1"
            for name, score in {
                **MODELS,
                "ensemble": "ROUND((score + points / 10 + points / 20 + score / 2) / 3, 6)",
            }.items()
        )
    ),
)
def ml_13(t):
    rows = b.labelled_weeks(t)
    keys = [*GROUP, "player_id"]
    scored = {name: rows.select(*keys, "y", F.expr(e).alias("score")) for name, e in MODELS.items()}
    mean = ranking.ensemble(*scored.values(), keys=keys).withColumn("score", F.round("score", 6))
    tables = {**scored, "ensemble": mean.select(*keys, "y", "score")}
    every = rollup.union_all(*[df.withColumn("model", F.lit(name)) for name, df in tables.items()])
    rates = ranking.hit_rates(every, ["model", *GROUP], "player_id", (1,), by=["model"])
    return rates.select("model", "groups", *rounded("top_1_hit_rate"))


# Five seeds on each of five season folds, rows and features drawn for each tree, stopped on the fold's season.
@query("ml_14")
def ml_14(t):
    rows = candidates(t)

    def run(season, train, validation, first):
        def fitted():
            marked = models.class_weights(train, "y").withColumn("held", F.lit(False))
            marked = marked.unionByName(validation.withColumns({"weight": F.lit(1.0), "held": F.lit(True)}))
            stages = models.feature_stages(marked.select(*STATS), exclude=(), scale=False)
            learner = models.boosted(rounds=500, depth=4, sample=0.7, features="0.5", held="held")
            found = models.fit_seeds(marked, stages, learner, (42, 76, 120, 271, 999))
            return [models.importances(model, STATS, first + i, t.spark) for i, model in enumerate(found)]

        return fitted

    folds = [f for f in splits.season_folds(rows, 5) if not f[1].isEmpty()]
    jobs = [run(*fold, 10 * i) for i, fold in enumerate(folds)]
    runs = rollup.union_all(*[one for fold in models.fit_side_by_side(jobs, most=5) for one in fold])
    summary = b.stored(ranking.importance_summary(runs))
    low = ranking.low_importance(summary).select("feature", F.lit(True).alias("low"))
    models_fitted = runs.agg(F.count_distinct("run").alias("n")).scalar()
    return summary.join(low, "feature", "left").fillna({"low": False}).withColumn("models", models_fitted)


@query("ml_15")
def ml_15(t):
    rows = candidates(t)

    def fit_and_score(train, validation, setting):
        train, validation = splits.standardise(train, STATS, validation)
        return models.linear_score(validation, models.fit_pairwise(train, GROUP, STATS, max_iter=100, **setting))

    grid = [{"reg": 0.001}, {"reg": 0.1}]
    return models.season_search(rows, grid, fit_and_score, GROUP, "player_id", folds=5)


RATES = """
SELECT week_start, conference, SUM(y) / COUNT(*) AS rate FROM b9 GROUP BY week_start, conference"""


@query(
    "ml_16",
    oracle(
        """
SELECT point, ROUND(x, 6) AS x, ROUND(density, 4) AS density, ROUND(MIN_BY(x, -density) OVER (), 6) AS peak,
       ROUND((SELECT SUM(y) / COUNT(*) FROM b9), 6) AS global_rate
FROM (SELECT CAST(i AS INTEGER) AS point, low + (high - low) * i / 499 AS x,
             SUM(EXP(-POW((low + (high - low) * i / 499 - rate) / h, 2) / 2)) / (MAX(n) * MAX(h) * SQRT(2 * PI())) AS density
      FROM rates JOIN (SELECT MIN(rate) AS low, MAX(rate) AS high, COUNT(*) AS n,
                              STDDEV_SAMP(rate) * POW(COUNT(*), -0.2) AS h FROM rates) s ON TRUE
      JOIN (SELECT unnest(range(0, 500)) AS i) g ON TRUE
      GROUP BY i, low, high) q""",
        rates=RATES,
    ),
)
def ml_16(t):
    rows = b.labelled_weeks(t)
    rates = rollup.label_counts(rows, GROUP, "y").select(
        (F.col("n_1") / (F.col("n_0") + F.col("n_1"))).alias("rate")
    )
    curve = b.stored(ranking.density(rates, "rate"))
    return (
        curve.withColumns(
            {
                "peak": ranking.density_peak(curve).scalar(),
                "global_rate": rows.agg(F.avg("y").alias("r")).scalar(),
            }
        )
        .select("point", *rounded("x"), *rounded("density", digits=4), *rounded("peak", "global_rate"))
    )


@query(
    "ml_17",
    oracle("""
SELECT 'histogram' AS part, bin, COUNT(*) AS rows, CAST(NULL AS DOUBLE) AS value
FROM (SELECT CAST(LEAST(FLOOR((points - lo) / (hi - lo) * 20), 19) AS INTEGER) AS bin
      FROM pw JOIN (SELECT MIN(points) AS lo, MAX(points) AS hi FROM pw) e ON TRUE) q GROUP BY bin
UNION ALL
SELECT 'quartile of ' || y, CAST(p * 100 AS INTEGER), NULL, ROUND(v, 6)
FROM (SELECT y, 0.25 AS p, quantile_cont(points, 0.25) AS v FROM b9 GROUP BY y
      UNION ALL SELECT y, 0.5, quantile_cont(points, 0.5) FROM b9 GROUP BY y
      UNION ALL SELECT y, 0.75, quantile_cont(points, 0.75) FROM b9 GROUP BY y) q"""),
)
def ml_17(t):
    bars = ranking.histogram(b.player_weeks(t), "points", 20).withColumns(
        {"part": F.lit("histogram"), "value": F.lit(None).cast("double")}
    )
    box = rollup.percentiles(b.labelled_weeks(t), ["y"], "points", [0.25, 0.5, 0.75]).select(
        F.concat(F.lit("quartile of "), F.col("y").cast("string")).alias("part"),
        F.round(F.col("p") * 100).cast("int").alias("bin"),
        F.lit(None).cast("bigint").alias("rows"),
        F.round("value", 6).alias("value"),
    )
    return bars.unionByName(box)


@query("ml_18")
def ml_18(t):
    rows = documents(t)
    train = models.class_weights(rows.where("lang <> 'fr'"), "y")
    stages = models.feature_stages(train, exclude=["doc_id", "y", "weight"], categories=["lang", "source"])
    path = scratch_path(t.spark)
    models.save(models.fit(train, stages, models.logistic(max_iter=1000)), path)
    # French was not seen in training: its one-hot columns are those of an unknown value.
    return models.score(models.load(path), rows).select("doc_id", "lang", "y", "prediction", "score")


@query("ml_19")
def ml_19(t):
    train, test = splits.season_split(candidates(t))
    train, test = splits.standardise(train, STATS, test)
    model = models.fit_group_perceptron(train, GROUP, STATS, hidden=(256, 128, 64), epochs=40)
    return model.score(test).select(*WEEK, "conference", "y", "score")
