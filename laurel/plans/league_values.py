"""Fixed values of the basketball feeds: schemas, teams, season dates, bands. Data only."""

# Team, conference, nickname.
TEAMS = (
    ("Boston Celtics", "East", "Celtics"),
    ("Brooklyn Nets", "East", "Nets"),
    ("New York Knicks", "East", "Knicks"),
    ("Philadelphia 76ers", "East", "76ers"),
    ("Philadelphia Sixers", "East", "Sixers"),
    ("Toronto Raptors", "East", "Raptors"),
    ("Chicago Bulls", "East", "Bulls"),
    ("Cleveland Cavaliers", "East", "Cavaliers"),
    ("Detroit Pistons", "East", "Pistons"),
    ("Indiana Pacers", "East", "Pacers"),
    ("Milwaukee Bucks", "East", "Bucks"),
    ("Atlanta Hawks", "East", "Hawks"),
    ("Charlotte Hornets", "East", "Hornets"),
    ("Miami Heat", "East", "Heat"),
    ("Orlando Magic", "East", "Magic"),
    ("Washington Wizards", "East", "Wizards"),
    ("Washington Bullets", "East", "Bullets"),
    ("New Jersey Nets", "East", "Nets"),
    ("Charlotte Bobcats", "East", "Bobcats"),
    ("Denver Nuggets", "West", "Nuggets"),
    ("Minnesota Timberwolves", "West", "Timberwolves"),
    ("Oklahoma City Thunder", "West", "Thunder"),
    ("Portland Trail Blazers", "West", "Trail Blazers"),
    ("Utah Jazz", "West", "Jazz"),
    ("Golden State Warriors", "West", "Warriors"),
    ("Los Angeles Clippers", "West", "Clippers"),
    ("LA Clippers", "West", "Clippers"),
    ("Los Angeles Lakers", "West", "Lakers"),
    ("Phoenix Suns", "West", "Suns"),
    ("Sacramento Kings", "West", "Kings"),
    ("Dallas Mavericks", "West", "Mavericks"),
    ("Houston Rockets", "West", "Rockets"),
    ("Memphis Grizzlies", "West", "Grizzlies"),
    ("New Orleans Pelicans", "West", "Pelicans"),
    ("San Antonio Spurs", "West", "Spurs"),
    ("Seattle SuperSonics", "West", "SuperSonics"),
    ("San Diego Clippers", "West", "Clippers"),
    ("Kansas City Kings", "West", "Kings"),
    ("New Orleans Hornets", "West", "Hornets"),
    ("Vancouver Grizzlies", "West", "Grizzlies"),
    ("Oklahoma City Hornets", "West", "Hornets"),
    ("New Orleans Jazz", "West", "Jazz"),
)

# Season, first day, last day. The first range that holds a date decides.
SEASON_RANGES = (
    (2025, "2025-10-02", "2026-08-01"),
    (2024, "2024-10-04", "2025-06-22"),
    (2023, "2023-10-05", "2024-06-17"),
    (2022, "2022-09-30", "2023-06-12"),
    (2021, "2021-10-03", "2022-06-16"),
    (2020, "2020-12-11", "2021-07-20"),
    (2019, "2019-10-22", "2020-10-11"),
    (2018, "2018-10-16", "2019-06-10"),
    (2017, "2017-09-30", "2018-06-08"),
    (2016, "2016-10-01", "2017-06-12"),
    (2015, "2015-10-02", "2016-06-19"),
    (2014, "2014-10-04", "2015-06-16"),
    (2013, "2013-10-05", "2014-06-15"),
    (2012, "2012-10-05", "2013-06-20"),
    (2011, "2011-12-16", "2012-06-21"),
    (2010, "2010-10-03", "2011-06-12"),
    (2009, "2009-10-01", "2010-06-17"),
    (2008, "2008-10-05", "2009-06-11"),
    (2007, "2007-10-06", "2008-06-17"),
    (2006, "2006-10-05", "2007-06-14"),
    (2005, "2005-10-10", "2006-04-19"),
    (2004, "2004-11-02", "2005-06-21"),
    (2003, "2003-10-28", "2004-06-15"),
    (2002, "2002-10-29", "2003-06-15"),
    (2001, "2001-10-30", "2002-04-17"),
    (2000, "2000-10-31", "2001-06-15"),
    (1999, "1999-11-02", "2000-04-19"),
    (1998, "1998-02-05", "1999-06-25"),
    (1997, "1997-10-31", "1998-06-14"),
    (1996, "1996-11-01", "1997-06-13"),
    (1995, "1995-11-03", "1996-04-21"),
    (1994, "1994-11-04", "1995-06-14"),
    (1993, "1993-11-05", "1994-04-24"),
    (1992, "1992-11-06", "1993-06-20"),
    (1991, "1991-11-01", "1992-06-12"),
    (1990, "1990-11-02", "1991-06-12"),
    (1989, "1989-11-03", "1990-06-14"),
    (1988, "1988-11-04", "1989-06-13"),
    (1987, "1987-11-06", "1988-06-19"),
    (1986, "1986-10-31", "1987-06-14"),
    (1985, "1985-10-25", "1986-06-05"),
    (1984, "1984-10-26", "1985-06-09"),
    (1983, "1983-10-28", "1984-06-12"),
    (1982, "1982-10-29", "1983-05-31"),
    (1981, "1981-10-30", "1982-06-06"),
    (1980, "1980-10-10", "1981-05-14"),
    (1979, "1979-10-12", "1980-05-16"),
    (1978, "1978-10-13", "1979-06-01"),
    (1977, "1977-10-18", "1978-06-07"),
    (1976, "1976-02-13", "1977-06-05"),
    (1975, "1976-02-03", "1976-06-06"),
    (1974, "1974-10-17", "1975-05-25"),
    (1973, "1973-10-09", "1974-05-12"),
    (1972, "1972-10-10", "1973-05-10"),
    (1971, "1971-10-12", "1972-05-07"),
    (1970, "1971-01-12", "1971-04-30"),
    (1969, "1969-10-14", "1970-05-08"),
    (1968, "1968-10-15", "1969-03-24"),
    (1967, "1967-10-13", "1968-05-02"),
    (1966, "1967-01-10", "1967-04-24"),
    (1965, "1965-10-15", "1966-04-28"),
    (1964, "1964-10-16", "1965-03-21"),
    (1963, "1963-10-16", "1964-04-26"),
    (1962, "1962-10-19", "1963-04-24"),
    (1961, "1961-02-16", "1962-04-18"),
    (1960, "1961-01-17", "1961-01-17"),
    (1959, "1959-10-18", "1960-04-09"),
    (1958, "1958-10-19", "1959-03-11"),
    (1957, "1957-10-22", "1958-03-12"),
    (1956, "1956-10-27", "1957-04-13"),
    (1955, "1955-11-05", "1956-04-05"),
    (1954, "1954-10-30", "1955-04-10"),
    (1953, "1953-10-30", "1954-04-11"),
    (1952, "1952-10-31", "1953-04-10"),
    (1951, "1951-11-01", "1952-04-23"),
    (1950, "1950-10-31", "1951-04-21"),
    (1949, "1949-10-29", "1950-04-23"),
    (1948, "1948-11-01", "1949-04-13"),
    (1947, "1947-11-12", "1948-04-21"),
    (1946, "1946-11-01", "1947-04-22"),
)

# Columns of the raw feeds.
GAMES_SCHEMA = (
    "gameId bigint, gameDateTimeEst string, hometeamCity string, hometeamName string, hometeamId bigint, "
    "awayteamCity string, awayteamName string, awayteamId bigint, homeScore int, awayScore int, "
    "winner bigint, gameType string, attendance int, arenaId bigint, gameLabel string, "
    "gameSubLabel string, seriesGameNumber int"
)
PLAYER_STATISTICS_SCHEMA = (
    "firstName string, lastName string, personId double, gameId bigint, gameDateTimeEst string, "
    "playerteamCity string, playerteamName string, opponentteamCity string, opponentteamName string, "
    "gameType string, gameLabel string, gameSubLabel string, seriesGameNumber int, win int, home int, "
    "numMinutes double, points double, assists double, blocks double, steals double, "
    "fieldGoalsAttempted double, fieldGoalsMade double, fieldGoalsPercentage double, "
    "threePointersAttempted double, threePointersMade double, threePointersPercentage double, "
    "freeThrowsAttempted double, freeThrowsMade double, freeThrowsPercentage double, "
    "reboundsDefensive double, reboundsOffensive double, reboundsTotal double, foulsPersonal double, "
    "turnovers double, plusMinusPoints double"
)
AWARDS_SCHEMA = (
    "player_id bigint, season string, player string, conference string, date date, team string, "
    "pos string, height string, weight string, age string, `Pre-Draft Team` string, "
    "`Draft Yr` string, yos string"
)

# Box-score columns that are whole numbers and are summed per week.
COUNTS = (
    "points", "assists", "blocks", "steals", "reboundsTotal", "reboundsDefensive", "reboundsOffensive",
    "fieldGoalsAttempted", "fieldGoalsMade", "threePointersAttempted", "threePointersMade",
    "freeThrowsAttempted", "freeThrowsMade", "turnovers", "foulsPersonal", "plusMinusPoints",
)

# Shooting percentages from weekly sums.
PERCENTAGES = {
    "fieldGoalsPercentage": ("fieldGoalsMade", "fieldGoalsAttempted"),
    "threePointersPercentage": ("threePointersMade", "threePointersAttempted"),
    "freeThrowsPercentage": ("freeThrowsMade", "freeThrowsAttempted"),
}

TENS = tuple((low, low + 9) for low in range(0, 100, 10))

# Bands whose games are counted per week; the last one is open.
BANDS = {
    "points": (*TENS, (100, None)),
    "assists": (*TENS[:4], (40, None)),
    "reboundsTotal": (*TENS[:4], (40, None)),
    "reboundsOffensive": (*TENS[:4], (40, None)),
    "reboundsDefensive": (*TENS[:4], (40, None)),
    "steals": ((0, 2), (3, 5), (6, 9), (10, None)),
    "blocks": ((0, 2), (3, 5), (6, 9), (10, 12), (13, 14), (15, None)),
}

# Our column → column of the published feature tables.
HONOUR_COLUMNS = {
    "all_star": "all_star_this_season",
    "mvp": "mvp_this_season",
    "first_team": "all_nba_first_team_this_season",
    "second_team": "all_nba_second_team_this_season",
    "third_team": "all_nba_third_team_this_season",
}
BREAKOUT = {"points": 0.5, "assists": 0.3, "plusMinusPoints": 0.2}
PRIOR_HONOUR_COLUMNS = {
    "all_star_last_season": "all_star_last_season",
    "mvp_last_season": "mvp_last_season",
    "first_team_last_season": "all_nba_first_team_last_season",
    "second_team_last_season": "all_nba_second_team_last_season",
    "third_team_last_season": "all_nba_third_team_last_season",
}
WIN_RATE_COLUMNS = {
    "avg_win_pct_this_week": "avg_full_season_win_pct_this_week",
    "win_pct_spread_this_week": "full_season_win_pct_max_minus_min_this_week",
}

# The running season and its first regular game; earlier games of it are preseason.
CURRENT_SEASON = 2025
OPENING_DAY = "2025-10-21"
