"""Text and date expressions on hand-made values."""

import datetime as dt

from pyspark.sql import functions as F

from laurel.functions import dates, text
from laurel.sources.pages import extract_award_rows


def values(spark, expression, data):
    df = spark.createDataFrame([(i, s) for i, s in enumerate(data)], "i int, s string")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("s"))).collect()]


def test_accents(spark):
    given = ["Nikola Đurišić", "Ægir Ørn ß", "plain", "ﬁ ½ İ", None]
    assert values(spark, text.strip_accents, given) == ["Nikola Durisic", "AEgir Orn ss", "plain", "fi 1⁄2 I", None]


def test_mojibake(spark):
    given = ["  Nikola JokiÄ\x87", "VuÄ\x8deviÄ", "Å engÃ¼n", "Ärger", "plain", "Jokić Ä", None]
    got = values(spark, text.fix_mojibake, given)
    # Å followed by a plain blank is no UTF-8, and a text with letters beyond Latin-1 is left alone.
    assert got == ["Nikola Jokić", "VuÄ\x8dević", "Å engÃ¼n", "Ärger", "plain", "Jokić ć", None]


def test_listed_names(spark):
    given = ["Fat Lever", "Cliff Robinson", "Jimmy Butler", "Tim Hardaway Jr.", "Dražen Petrović", "Steve Smith"]
    assert values(spark, text.listed_name, given) == [
        "Lafayette Lever", "Clifford Robinson", "Jimmy Butler III", "Tim Hardaway", "Drazen Petrovic", "Steven Smith",
    ]


def test_timestamps(spark):
    given = ["2024-01-05", "2024-01-05 19:30:00", "2024-01-05T19:30:00Z", "2024-01-05 23:30:00-05:00", "05/01/2024", "soon", None]
    got = values(spark, lambda s: dates.parse_timestamp(s).cast("date"), given)
    fifth = dt.date(2024, 1, 5)
    assert got == [fifth, fifth, fifth, dt.date(2024, 1, 6), fifth, None, None]


def test_award_dates(spark):
    got = values(spark, lambda s: dates.award_week_start(s.cast("date")), ["2021-01-04", "2021-01-11"])
    assert got == [dt.date(2020, 12, 28), dt.date(2021, 1, 4)]


PAGE = """
<div class="data_grid_group"><h3>2023-24 <em>season</em></h3>
 <div class="data_grid_box"><div class="gridtitle">January</div><div>
  <p><strong>Jan 8</strong><br><a data-desc="Eastern POW">A One</a>, <a data-desc="Eastern POW">B &amp; Two</a>
     <a data-desc="Western POW">C Three</a></p>
  <p><strong>Jan 15</strong> <a data-desc="">D Four</a></p>
  <p>No date <a data-desc="Eastern">Nobody</a></p></div></div>
 <div class="data_grid_box"><div class="gridtitle">February</div>
  <p><strong>Feb 5</strong><a href="/x">E Five</a><a href="/y"> </a></p></div></div>
<div class="other"><p><strong>Feb 9</strong><a>F Six</a></p></div>
"""


def test_award_page(spark):
    pages = spark.createDataFrame([(1, PAGE), (2, "<p>nothing</p>"), (3, None)], "page_id bigint, html string")
    got = [tuple(r)[1:] for r in extract_award_rows(pages).orderBy("month", "date", "player").collect()]
    s = "2023-24 season"
    assert got == [
        (s, "February", "Feb 5", "A", "E Five", 0),
        (s, "January", "Jan 15", "A", "D Four", 0),
        (s, "January", "Jan 8", "E", "A One", 1),
        (s, "January", "Jan 8", "E", "B & Two", 1),
        (s, "January", "Jan 8", "W", "C Three", 0),
    ]
