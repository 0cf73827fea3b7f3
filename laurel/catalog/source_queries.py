"""Checked queries of sources (SRC) and sinks (SNK): written, then read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from laurel.catalog import bindings as b
from laurel.catalog.bindings import oracle
from laurel.catalog.registry import query
from laurel.functions import dates
from laurel.plans import league
from laurel.session import broadcast_bounded, scratch_path
from laurel.sources import database, pages, tables

NATION = "n_nationkey int, n_name string, n_regionkey int"


@query("src_1", "SELECT n_nationkey, n_name, n_regionkey FROM nation")
def src_1(t):
    path = scratch_path(t.spark)
    tables.write_table(t.nation, path, file_format="csv")
    return tables.read_table(t.spark, path, NATION)


@query(
    "src_2",
    """
SELECT l_suppkey, COUNT(*) AS lines, CAST(SUM(l_quantity) AS BIGINT) AS quantity FROM lineitem GROUP BY l_suppkey""",
)
def src_2(t):
    path = scratch_path(t.spark)
    lines = t.lineitem.select("l_orderkey", "l_suppkey", "l_quantity")
    tables.write_table(lines, path, file_format="csv")
    read = tables.read_table(t.spark, path, "l_orderkey bigint, l_suppkey bigint, l_quantity double")
    return read.groupBy("l_suppkey").agg(
        F.count(F.lit(1)).alias("lines"), F.sum("l_quantity").cast("bigint").alias("quantity")
    )


@query("src_3", "SELECT c_custkey, c_name, c_acctbal FROM customer")
def src_3(t):
    path = scratch_path(t.spark)
    tables.write_gzip_csv(t.customer.select("c_custkey", "c_name", "c_acctbal"), path)
    return tables.read_table(t.spark, path, "c_custkey bigint, c_name string, c_acctbal double")


@query(
    "src_4",
    """
SELECT 'nation' AS table_name, COUNT(*) AS rows FROM nation UNION ALL SELECT 'supplier', COUNT(*) FROM supplier
UNION ALL SELECT 'orders', COUNT(*) FROM orders""",
)
def src_4(t):
    folder = scratch_path(t.spark)
    # A missing table fails and is reported; the export goes on.
    status = database.export_database(
        lambda name: getattr(t, name),
        ["nation", "no_such_table", "region", "supplier", "orders"],
        folder,
        exclude=["region"],
    )
    if status["region"] != "excluded" or not status["no_such_table"].startswith("failed"):
        raise AssertionError(status)
    return database.exported_counts(t.spark, folder, status)


@query(
    "src_5",
    "SELECT n_regionkey, COUNT(*) AS nations, TRUE AS listed FROM nation GROUP BY n_regionkey",
)
def src_5(t):
    t.nation.createOrReplaceTempView("laurel_nation")
    source = database.CatalogDatabase(t.spark)
    listed = "laurel_nation" in source.list_tables("laurel_")
    counts = source.query("SELECT n_regionkey, count(*) AS nations FROM laurel_nation GROUP BY n_regionkey")
    return counts.withColumn("listed", F.lit(listed))


@query(
    "src_6",
    """
SELECT page_id, NULLIF(trim(regexp_extract(html, '<h1>(.*?)</h1>', 1, 's')), '') AS heading,
       CAST(position - 1 AS INTEGER) AS position, links[position] AS link
FROM (SELECT page_id, html, links, unnest(range(1, len(links) + 1)) AS position
      FROM (SELECT page_id, html, regexp_extract_all(regexp_extract(html, '<nav>(.*?)</nav>', 1, 's'),
                                                     '<a href="[^"]*">(.*?)</a>', 1) AS links FROM pages) p) q""",
)
def src_6(t):
    return pages.extract_links(t.pages)


def award_pages(awards):
    """One award page per season: a box per week, marked winners in one paragraph, unmarked ones in another."""
    date, conference = F.col("date"), F.col("conference")
    name = F.concat(F.lit("Player "), F.col("player_id").cast("string"))
    mark = F.when(conference < 2, "Eastern").otherwise("Western")
    link = F.when(
        conference < 4, F.format_string('<a data-desc="%s Conference Player of the Week">%s</a>', mark, name)
    ).otherwise(F.format_string("<a>%s</a>", name))
    first = dates.season_of(date)
    week = awards.withColumn("marked", conference < 4).groupBy("date", "marked").agg(
        F.array_join(F.sort_array(F.collect_list(link)), "").alias("links")
    )
    paragraph = F.format_string("<p><strong>%s</strong>%s</p>", F.date_format("date", "MMM d"), F.col("links"))
    box = F.format_string(
        '<div class="data_grid_box"><div class="gridtitle">%s</div>%s</div>', F.date_format("date", "MMMM"), paragraph
    )
    # A season has at most 54 weeks.
    return week.groupBy(first.alias("page_id")).agg(F.array_join(F.collect_list(box), "").alias("boxes")).select(
        F.col("page_id").cast("bigint").alias("page_id"),
        F.format_string(
            '<div class="data_grid_group"><h3>%d-%02d</h3>%s</div>',
            F.col("page_id"), (F.col("page_id") + 1) % 100, F.col("boxes"),
        ).alias("html"),
    )


@query(
    "src_6_awards",
    oracle("""
SELECT season || '-' || lpad(CAST((season + 1) % 100 AS VARCHAR), 2, '0') AS season, date,
       CAST(YEAR(date) AS INTEGER) AS year, CAST(weekofyear(date) AS INTEGER) AS week, letter AS conference,
       'Player ' || player_id AS player,
       CAST(CASE WHEN COUNT(*) OVER (PARTITION BY date, letter) > 1 THEN 1 ELSE 0 END AS INTEGER) AS tie
FROM (SELECT player_id, date, CASE WHEN conference < 2 THEN 'E' WHEN conference < 4 THEN 'W' ELSE 'A' END AS letter,
             CASE WHEN MONTH(date) >= 7 THEN YEAR(date) ELSE YEAR(date) - 1 END AS season FROM b3) q"""),
)
def src_6_awards(t):
    rows = pages.extract_award_rows(award_pages(b.awards(t)))
    return league.award_list(rows).select("season", "date", "year", "week", "conference", "player", "tie")


@query(
    "src_7",
    """
SELECT o_orderkey, name AS month FROM orders JOIN (VALUES """
    + ", ".join(f"({i}, '{m}')" for i, m in enumerate(dates.MONTHS, start=1))
    + ") m(number, name) ON MONTH(o_orderdate) = number",
)
def src_7(t):
    months = tables.read_literal(t.spark, list(enumerate(dates.MONTHS, start=1)), "number int, month string")
    rows = t.orders.select("o_orderkey", F.month("o_orderdate").alias("number"))
    return rows.join(broadcast_bounded(months), "number").select("o_orderkey", "month")


@query("src_8", "SELECT s_suppkey, s_nationkey FROM supplier")
def src_8(t):
    return tables.read_path_sql(t.spark, f"{t.sf_dir}/supplier.parquet", "s_suppkey, s_nationkey")


@query("snk_1", "SELECT p_partkey, p_brand, p_size FROM part")
def snk_1(t):
    path = scratch_path(t.spark)
    rows = t.part.select("p_partkey", "p_brand", "p_size")
    tables.write_table(rows.where("p_size > 10"), path)
    tables.write_table(rows, path)
    return tables.read_parquet(t.spark, path)


@query(
    "snk_2",
    "SELECT r_regionkey, COUNT(*) * 2 AS copies FROM region GROUP BY r_regionkey",
)
def snk_2(t):
    path = scratch_path(t.spark)
    for mode in ("replace", "append", "skip"):
        tables.write_table(t.region, path, mode)
    copies = tables.read_parquet(t.spark, path, ["r_regionkey"])
    return copies.groupBy("r_regionkey").agg(F.count(F.lit(1)).alias("copies"))


@query("snk_3", "SELECT event_type, COUNT(*) AS rows FROM events GROUP BY event_type")
def snk_3(t):
    path = scratch_path(t.spark)
    tables.copy_through(t.spark, f"{t.sf_dir}/events.parquet", path)
    return tables.read_parquet(t.spark, path).groupBy("event_type").agg(F.count(F.lit(1)).alias("rows"))
