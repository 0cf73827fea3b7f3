"""Checked queries of column work: PRJ, FLT and the scalar functions STR, DAT, MTH, ARR; UDF forms."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F, types as T

from laurel.catalog import bindings as b
from laurel.catalog.bindings import oracle
from laurel.catalog.registry import query
from laurel.functions import dates, numbers, text
from laurel.operators import cleaning, groups, ordered, rollup
from laurel.plans.features import league_normalise


@query("prj_1", "SELECT o_orderdate, o_orderkey, o_totalprice FROM orders")
def prj_1(t):
    return t.orders.select("o_orderdate", "o_orderkey", "o_totalprice")


@query(
    "prj_2",
    """
SELECT o_orderkey AS gameid, CAST(o_orderdate AS DATE) AS gamedate, CAST(FLOOR(o_totalprice) AS BIGINT) AS score,
       TRY_CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS priority,
       TRY_CAST(o_orderstatus AS INTEGER) AS status FROM orders""",
)
def prj_2(t):
    schema = T.StructType(
        [
            T.StructField("gameid", T.LongType()),
            T.StructField("gamedate", T.DateType()),
            T.StructField("score", T.LongType()),
            T.StructField("priority", T.IntegerType()),
            T.StructField("status", T.IntegerType()),
        ]
    )
    raw = t.orders.select(
        F.col("o_orderkey").alias("gameId"),
        F.col("o_orderdate").cast("string").alias("gameDateTimeEst"),
        F.floor("o_totalprice").alias("Score"),
        F.substring("o_orderpriority", 1, 1).alias("PRIORITY"),
        F.col("o_orderstatus").alias("Status"),
    )
    return cleaning.conform(raw, schema, {"gameDateTimeEst": "gameDate"})


@query("prj_3", "SELECT s_name, s_suppkey, s_nationkey FROM supplier")
def prj_3(t):
    return cleaning.keys_first(t.supplier, ["s_name"], drop=["s_acctbal"])


@query(
    "prj_4",
    """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_shipdate,
       CAST(CASE WHEN NULLIF(l_returnflag, 'R') = 'A' THEN 1 ELSE 0 END AS INTEGER) AS returned,
       CASE WHEN l_quantity < 10 THEN 'low' WHEN l_quantity < 30 THEN 'middle' ELSE 'high' END AS size
FROM lineitem""",
)
def prj_4(t):
    q = F.col("l_quantity")
    return t.lineitem.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate",
        cleaning.flag(F.nullif("l_returnflag", F.lit("R")) == "A").alias("returned"),
        cleaning.choose([(q < 10, "low"), (q < 30, "middle")], "high").alias("size"),
    )


@query(
    "prj_5",
    """
SELECT o_orderkey, o_orderstatus || '-' || CAST(o_custkey AS VARCHAR) AS record,
       CAST(YEAR(o_orderdate) AS VARCHAR) || '_' || CAST(WEEK(o_orderdate) AS VARCHAR) || '_' || o_orderstatus AS key,
       NULLIF(o_orderstatus, 'P') || ' ' || o_orderpriority AS full_name FROM orders""",
)
def prj_5(t):
    return t.orders.select(
        "o_orderkey",
        F.concat_ws("-", "o_orderstatus", "o_custkey").alias("record"),
        F.concat_ws("_", F.year("o_orderdate"), F.weekofyear("o_orderdate"), "o_orderstatus").alias("key"),
        # NULL when any part is, unlike concat_ws.
        F.concat(F.nullif("o_orderstatus", F.lit("P")), F.lit(" "), "o_orderpriority").alias("full_name"),
    )


@query(
    "prj_6",
    """
SELECT event_id, CAST(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS INTEGER) AS event_type_error,
       CAST(CASE WHEN event_type = 'view' THEN 1 ELSE 0 END AS INTEGER) AS event_type_view, 0 AS event_type_zzz
FROM events""",
)
def prj_6(t):
    # `click` is the first training value and dropped; `zzz` no longer occurs.
    values = {"event_type": ["click", "error", "view", "zzz"]}
    return cleaning.one_hot(t.events.select("event_id", "event_type"), values, drop_first=True)


@query(
    "prj_7",
    """
SELECT doc_id, lang, CAST(DENSE_RANK() OVER (ORDER BY lang) - 1 AS BIGINT) AS lang_code FROM documents""",
)
def prj_7(t):
    return cleaning.index_category(t.documents.select("doc_id", "lang"), "lang", "lang_code")


@query(
    "flt_1",
    """
SELECT o_orderkey, o_orderdate FROM orders
WHERE o_orderdate >= TIMESTAMP '1998-01-01' AND (o_orderpriority LIKE '1%' OR o_orderpriority LIKE '5%')""",
)
def flt_1(t):
    urgent = F.col("o_orderpriority").startswith("1") | F.col("o_orderpriority").startswith("5")
    return t.orders.where("o_orderdate >= timestamp_ntz'1998-01-01'").where(urgent).select("o_orderkey", "o_orderdate")


NULLED = """
SELECT event_id, NULLIF(user_id, 3) AS user_id, NULLIF(event_type, 'error') AS event_type,
       CASE WHEN value >= 5 THEN value END AS value FROM events"""


def nulled(t):
    return t.events.select(
        "event_id",
        F.nullif("user_id", F.lit(3)).alias("user_id"),
        F.nullif("event_type", F.lit("error")).alias("event_type"),
        F.when(F.col("value") >= 5, F.col("value")).alias("value"),
    )


@query(
    "flt_2",
    oracle(
        "SELECT event_id, 1 AS complete FROM nulled WHERE user_id IS NOT NULL AND event_type IS NOT NULL "
        "AND value IS NOT NULL UNION ALL SELECT event_id, 0 FROM nulled WHERE user_id IS NOT NULL",
        nulled=NULLED,
    ),
)
def flt_2(t):
    rows = nulled(t)
    complete = rows.dropna("any").select("event_id", F.lit(1).alias("complete"))
    return complete.unionAll(rows.dropna(subset=["user_id"]).select("event_id", F.lit(0)))


@query(
    "flt_3",
    oracle(
        "SELECT event_id, COALESCE(user_id, -1) AS user_id, COALESCE(event_type, 'none') AS event_type, "
        "COALESCE(value, 0.5) AS value FROM nulled",
        nulled=NULLED,
    ),
)
def flt_3(t):
    return nulled(t).fillna({"user_id": -1, "event_type": "none", "value": 0.5})


@query(
    "flt_4",
    oracle(
        "SELECT event_id, ROUND(COALESCE(value, (SELECT AVG(value) FROM nulled)), 6) AS value FROM nulled",
        nulled=NULLED,
    ),
)
def flt_4(t):
    rows = cleaning.fill_with_mean(nulled(t).select("event_id", "value"), ["value"])
    return rows.withColumn("value", F.round("value", 6))


@query(
    "flt_5",
    """
SELECT p_partkey FROM part
WHERE p_name LIKE '%ring%' OR p_brand IN ('Brand#1', 'Brand#2') OR p_size BETWEEN 10 AND 12""",
)
def flt_5(t):
    name, brand, size = F.col("p_name"), F.col("p_brand"), F.col("p_size")
    return t.part.where(
        name.like("%ring%") | brand.isin("Brand#1", "Brand#2") | size.between(10, 12)
    ).select("p_partkey")


@query(
    "flt_6",
    oracle(
        """
SELECT COUNT(*) FILTER (user_id IS NULL) AS user_id_nulls, COUNT(*) FILTER (event_type IS NULL) AS event_type_nulls,
       COUNT(*) FILTER (value IS NULL) AS value_nulls,
       COUNT(*) FILTER (user_id IS NULL OR event_type IS NULL OR value IS NULL) AS rows_with_null FROM nulled""",
        nulled=NULLED,
    ),
)
def flt_6(t):
    return cleaning.null_profile(nulled(t), ["user_id", "event_type", "value"])


@query(
    "flt_7",
    """
SELECT l_orderkey, l_linenumber, MIN(l_partkey) AS l_partkey, 'key' AS how FROM lineitem GROUP BY 1, 2
UNION ALL SELECT * FROM (SELECT DISTINCT l_orderkey, l_linenumber, 0, 'row' FROM lineitem) q""",
)
def flt_7(t):
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey")
    by_key = cleaning.first_per_key(lines, ["l_orderkey", "l_linenumber"], ["l_partkey"])
    by_row = lines.select("l_orderkey", "l_linenumber").distinct()
    return by_key.withColumn("how", F.lit("key")).unionAll(
        by_row.select("*", F.lit(0).cast("bigint"), F.lit("row"))
    )


# All words of all documents, once each.
WORDS = """
SELECT DISTINCT word FROM (SELECT unnest(regexp_split_to_array(trim(text), '[ \\t\\n\\r\\f\\v]+')) AS word FROM documents) q
WHERE word <> ''"""


def document_words(t):
    word = F.explode(F.split(F.trim("text"), "[ \\t\\n\\r\\f\\u000B]+")).alias("word")
    return t.documents.select(word).where("word <> ''").distinct()


def spelled_sql(column):
    for letter, plain in text.SPELLED_OUT.items():
        column = f"replace({column}, '{letter}', '{plain}')"
    return f"strip_accents({column})"


@query(
    "str_a",
    oracle(
        f"SELECT word, {spelled_sql('word')} AS plain FROM words",
        words=WORDS,
    ),
)
def str_a(t):
    return document_words(t).select("word", text.strip_accents(F.col("word")).alias("plain"))


@query(
    "str_b",
    oracle(
        "SELECT word, CASE WHEN word LIKE '%Ä' THEN substr(word, 1, length(word) - 1) || 'ć' ELSE word END AS repaired "
        "FROM words",
        words=WORDS,
    ),
)
def str_b(t):
    # What a reader that takes UTF-8 for Latin-1 makes of the word.
    broken = F.decode(F.encode("word", "UTF-8"), "ISO-8859-1")
    return document_words(t).select("word", text.fix_mojibake(broken).alias("repaired"))


@query("str_c", "SELECT doc_id, NULLIF(trim(replace(lang, 'de', '  ')), '') AS lang FROM documents")
def str_c(t):
    return t.documents.select(
        "doc_id", text.strip_or_null(F.regexp_replace("lang", "de", "  ")).alias("lang")
    )


@query(
    "str_d",
    """
SELECT p_partkey, split_part(p_name, ' ', 1) AS first, split_part(p_name, ' ', -1) AS last,
       substr(p_type, 1, 4) AS prefix FROM part""",
)
def str_d(t):
    name = F.col("p_name")
    return t.part.select(
        "p_partkey",
        text.first_word(name).alias("first"),
        text.last_word(name).alias("last"),
        F.substring("p_type", 1, 4).alias("prefix"),
    )


@query(
    "str_e",
    """
SELECT p_partkey, CASE split_part(p_name, ' ', 1) WHEN 'red' THEN 'Crimson' WHEN 'blue' THEN 'Navy'
                  ELSE split_part(p_name, ' ', 1) END || ' ' ||
                  CASE split_part(p_name, ' ', -1) WHEN 'ring' THEN 'Band' ELSE split_part(p_name, ' ', -1) END AS name
FROM part""",
)
def str_e(t):
    name = F.col("p_name")
    first = text.replace_values(text.first_word(name), {"red": "Crimson", "blue": "Navy"})
    last = text.replace_values(text.last_word(name), {"ring": "Band"})
    return t.part.select("p_partkey", F.concat_ws(" ", first, last).alias("name"))


@query(
    "str_f",
    """
SELECT c_custkey, lower(c_mktsegment) AS segment, starts_with(c_mktsegment, 'M') AS is_m,
       CAST(c_nationkey AS VARCHAR) || '_' || c_mktsegment AS key FROM customer""",
)
def str_f(t):
    return t.customer.select(
        "c_custkey",
        F.lower("c_mktsegment").alias("segment"),
        F.col("c_mktsegment").startswith("M").alias("is_m"),
        F.concat_ws("_", "c_nationkey", "c_mktsegment").alias("key"),
    )


@query("str_g", "SELECT doc_id, regexp_matches(text, '[ÃÂÄÅ]') AS marked, regexp_matches(text, '[0-9]{4}') AS number FROM documents")
def str_g(t):
    return t.documents.select(
        "doc_id",
        F.col("text").rlike(text.MOJIBAKE_MARKS).alias("marked"),
        F.col("text").rlike("[0-9]{4}").alias("number"),
    )


@query(
    "dat_a",
    """
SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 4 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS day FROM orders""",
)
def dat_a(t):
    day, key = F.col("o_orderdate"), F.col("o_orderkey")
    spelled = (
        F.when(key % 5 == 0, F.date_format(day, "yyyy-MM-dd"))
        .when(key % 5 == 1, F.date_format(day, "yyyy-MM-dd HH:mm:ss"))
        .when(key % 5 == 2, F.date_format(day, "dd/MM/yyyy"))
        .when(key % 5 == 3, F.concat(F.date_format(day, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z")))
        .otherwise("no date")
    )
    return t.orders.select("o_orderkey", dates.parse_timestamp(spelled).cast("date").alias("day"))


@query(
    "dat_b",
    """
SELECT o_orderkey, CAST(DAY(o_orderdate) AS INTEGER) AS day, CAST(MONTH(o_orderdate) AS INTEGER) AS month,
       CAST(YEAR(o_orderdate) AS INTEGER) AS year, CAST(WEEK(o_orderdate) AS INTEGER) AS week,
       CAST(ISOYEAR(o_orderdate) AS INTEGER) AS week_year FROM orders""",
)
def dat_b(t):
    day = F.col("o_orderdate")
    return t.orders.select(
        "o_orderkey",
        F.dayofmonth(day).alias("day"),
        F.month(day).alias("month"),
        F.year(day).alias("year"),
        dates.iso_week(day).alias("week"),
        dates.iso_year(day).alias("week_year"),
    )


@query(
    "dat_c",
    """
SELECT o_orderkey, CAST(date_trunc('week', o_orderdate) AS DATE) AS monday,
       CAST(CAST(o_orderdate AS DATE) - 1 AS DATE) AS day_before,
       CAST(date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) AS INTEGER) AS days,
       CAST(CAST(o_orderdate AS DATE) + 21 AS DATE) AS three_weeks FROM orders""",
)
def dat_c(t):
    day = F.col("o_orderdate").cast("date")
    return t.orders.select(
        "o_orderkey",
        dates.week_start(day).alias("monday"),
        F.date_sub(day, 1).alias("day_before"),
        F.datediff(day, F.lit("1995-01-01").cast("date")).alias("days"),
        F.date_add(day, 3 * 7).alias("three_weeks"),
    )


DAT_D_RULES = [(1998, "1998-02-05", "1999-06-25"), (1997, "1997-10-31", "1998-06-14"), (1996, "1996-11-01", "1997-06-13")]


@query(
    "dat_d",
    """
SELECT o_orderkey, CAST(YEAR(o_orderdate) - CASE WHEN MONTH(o_orderdate) < 7 THEN 1 ELSE 0 END AS INTEGER) AS by_month,
       CAST(YEAR(o_orderdate) AS INTEGER) AS by_text,
       CAST(CASE WHEN CAST(o_orderdate AS DATE) BETWEEN DATE '1998-02-05' AND DATE '1999-06-25' THEN 1998
            WHEN CAST(o_orderdate AS DATE) BETWEEN DATE '1997-10-31' AND DATE '1998-06-14' THEN 1997
            WHEN CAST(o_orderdate AS DATE) BETWEEN DATE '1996-11-01' AND DATE '1997-06-13' THEN 1996 END AS INTEGER) AS by_rules
FROM orders""",
)
def dat_d(t):
    day = F.col("o_orderdate").cast("date")
    season_text = F.concat_ws("-", F.year(day), F.lit("99"))
    return t.orders.select(
        "o_orderkey",
        dates.season_of(day).alias("by_month"),
        dates.season_of_text(season_text).alias("by_text"),
        dates.season_by_rules(day, DAT_D_RULES).alias("by_rules"),
    )


@query(
    "dat_e",
    """
SELECT o_orderkey, CAST(MONTH(o_orderdate) AS INTEGER) AS month,
       CAST(CASE WHEN MONTH(o_orderdate) > 6 THEN 1990 ELSE 1991 END AS INTEGER) AS year FROM orders""",
)
def dat_e(t):
    month = dates.month_number(F.date_format("o_orderdate", "MMMM"))
    return t.orders.select(
        "o_orderkey", month.alias("month"), dates.award_year(F.lit("1990-91"), month).alias("year")
    )


@query("dat_f", "SELECT event_id, ts AS local_ts, CAST(ts AS DATE) AS day FROM events")
def dat_f(t):
    zoned = F.to_utc_timestamp(F.to_timestamp_ltz(F.col("ts").cast("string")), "UTC")
    return t.events.select(
        "event_id", zoned.cast("timestamp_ntz").alias("local_ts"), zoned.cast("date").alias("day")
    )


@query(
    "mth_a",
    oracle("""
SELECT b2.gameid, b2.player_id, ROUND(CASE WHEN sd > 0 THEN (points - mu) / sd ELSE 0 END, 6) AS z
FROM b2 JOIN (SELECT player_id, AVG(points) AS mu, CASE WHEN player_id % 3 = 0 THEN 0 ELSE STDDEV_POP(points) END AS sd
              FROM b2 GROUP BY player_id) s ON b2.player_id = s.player_id"""),
)
def mth_a(t):
    rows = b.box(t)
    stats = rows.groupBy("player_id").agg(F.avg("points").alias("mu"), F.stddev_pop("points").alias("sd"))
    sd = F.when(F.col("player_id") % 3 == 0, F.lit(0.0)).otherwise(F.col("sd"))
    return rows.join(stats, "player_id").select(
        "gameid", "player_id", F.round(numbers.z_score(F.col("points"), F.col("mu"), sd), 6).alias("z")
    )


@query(
    "mth_b",
    oracle("SELECT gameid, player_id, ROUND(CAST(0.5 * points + 0.3 * assists + 0.2 * plus_minus AS DOUBLE), 6) AS score FROM b2"),
)
def mth_b(t):
    score = numbers.composite(numbers.BREAKOUT_WEIGHTS)
    return b.box(t).select("gameid", "player_id", F.round(score, 6).alias("score"))


@query(
    "mth_c",
    oracle("""
SELECT p.player_id, p.teamid, p.season, p.week_start, ROUND(COALESCE((points - m) / NULLIF(s, 0), 0), 6) AS z_s_points
FROM pw p LEFT JOIN (SELECT season + 1 AS season, AVG(points) AS m, STDDEV_SAMP(points) AS s FROM pw GROUP BY season) l
  ON p.season = l.season"""),
)
def mth_c(t):
    rows = league_normalise(b.stored(b.player_weeks(t)), ["points"])
    return rows.select("player_id", "teamid", "season", "week_start", F.round("z_s_points", 6).alias("z_s_points"))


@query(
    "mth_d",
    """
SELECT o_orderkey, CAST(CEIL(o_custkey / 7) AS BIGINT) AS weeks, o_orderkey // 2 AS pair, o_orderkey % 2 AS side FROM orders""",
)
def mth_d(t):
    key = F.col("o_orderkey")
    return t.orders.select(
        "o_orderkey",
        numbers.ceil_div(F.col("o_custkey"), 7).alias("weeks"),
        numbers.pair_number(key).alias("pair"),
        F.pmod(key, F.lit(2)).alias("side"),
    )


@query("mth_e", "SELECT c_custkey, CAST(trunc(c_acctbal / 7 - 300) AS INTEGER) AS whole FROM customer")
def mth_e(t):
    return t.customer.select("c_custkey", numbers.truncate(F.col("c_acctbal") / 7 - 300).alias("whole"))


@query(
    "arr_a",
    oracle("""
SELECT gameid, teamid, CAST(COUNT(DISTINCT player_id) AS INTEGER) AS size,
       MAX(CASE WHEN player_id = 7 THEN 1 ELSE 0 END) = 1 AS has_7,
       MAX(CASE WHEN player_id IN (1, 2, 3, 5, 8) THEN 1 ELSE 0 END) = 1 AS overlaps
FROM b2 GROUP BY gameid, teamid"""),
)
def arr_a(t):
    asked = {"has_7": (7,), "overlaps": (1, 2, 3, 5, 8)}
    return rollup.membership(b.box(t), ["gameid", "teamid"], "player_id", asked)


@query(
    "udf_1",
    oracle(f"SELECT s_suppkey, {spelled_sql('s_name')} AS plain FROM supplier"),
)
def udf_1(t):
    return t.supplier.select("s_suppkey", text.strip_accents(F.col("s_name")).alias("plain"))


@query("udf_2", "SELECT c_custkey, c_name || '/' || c_mktsegment AS label FROM customer")
def udf_2(t):
    # A row function of the kind `apply(axis=1)` is a column expression.
    return t.customer.select("c_custkey", F.concat_ws("/", "c_name", "c_mktsegment").alias("label"))


@query(
    "udf_3",
    oracle("""
SELECT player_id, teamid, season, week_start,
       CAST(COALESCE(SUM(points) OVER (PARTITION BY player_id, season ORDER BY week_start, teamid
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS points_prior FROM pw"""),
)
def udf_3(t):
    # A group transform of the kind `transform(lambda s: ...)` is a window.
    rows = ordered.prior_sum(
        b.player_weeks(t), ["player_id", "season"], ["week_start", "teamid"], {"points_prior": "points"}, max_rows=None
    )
    return rows.select("player_id", "teamid", "season", "week_start", "points_prior")


# The load rises by what goes beyond 25 points a week, is never below 0 and stops at 150: no window says that.
@query(
    "udf_4",
    oracle("""
SELECT player_id, season, CAST(len(p) AS BIGINT) AS weeks,
       list_reduce(list_concat([CAST(0 AS BIGINT)], p), lambda load, x: least(150, greatest(0, load + x - 25))) AS load
FROM (SELECT player_id, season, list(CAST(points AS BIGINT) ORDER BY week_start, teamid) AS p FROM pw GROUP BY player_id, season) q"""),
)
def udf_4(t):
    def step(state, rows):
        weeks, load = state
        for points in rows["points"]:
            load = min(150, max(0, load + int(points) - 25))
        return (weeks + len(rows), load), None

    def finish(key, state):
        return pd.DataFrame([(*key, *state)], columns=["player_id", "season", "weeks", "load"])

    rows = b.player_weeks(t).select("player_id", "season", "week_start", "teamid", "points")
    schema = "player_id bigint, season int, weeks bigint, load bigint"
    return groups.scan_groups(rows, ["player_id", "season"], ["week_start", "teamid"], lambda: (0, 0), step, finish, schema)


@query(
    "udf_5",
    oracle("SELECT player_id, ROUND(date_diff('day', MIN(date), MAX(date)) / 365, 6) AS span_years FROM b3 GROUP BY player_id"),
)
def udf_5(t):
    # An aggregate lambda over (max - min) is a pair of built-in aggregates.
    return rollup.spans(b.awards_from_games(t), "player_id", "date").withColumn(
        "span_years", F.round("span_years", 6)
    )
