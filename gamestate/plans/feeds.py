"""Landed documents of every feed, made from the test tables, written as JSON lines, read back and normalised."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gamestate.operators import game, onice, schedule
from gamestate.plans import seasons
from gamestate.plans.registry import query, table
from gamestate.plans.storage import folder
from gamestate.sources import landed, lines
from gamestate.streaming import incremental, progress


def _land(docs: DataFrame, broken: int = 0) -> str:
    """The folder of the documents (columns to JSON lines), with some lines that are no JSON."""
    path = folder(docs.sparkSession)
    docs.select(F.to_json(F.struct(*docs.columns)).alias("value")).write.text(path)
    if broken:
        docs.sparkSession.range(broken).select(F.concat(F.lit('{"id": '), F.col("id").cast("string")).alias("value")).write.mode("append").text(path)
    return path


def _team(side: str, number: str, score: str, odds: str) -> F.Column:
    offers = F.expr(f"if(o_orderkey % 3 = 0, null, array(named_struct('providerId', 8, 'value', 'none'), named_struct('providerId', 9, 'value', {odds})))")
    return F.struct(F.expr(f"cast({number} as string)").alias("id"), F.expr(f"concat('{side}', {number})").alias("abbrev"), F.expr(score).alias("score"), offers.alias("odds"))


def _schedule_docs(spark: SparkSession, sf_dir: str, game_state: F.Column) -> DataFrame:
    """Schedule documents of a day, as many as its games fill."""
    start = F.date_format(F.col("o_orderdate") + F.expr("make_interval(0, 0, 0, 0, o_orderkey % 24, 0, 0)"), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    state = F.when(F.col("o_orderstatus") == "F", "Final").otherwise(F.col("o_orderstatus"))
    g = F.struct(
        F.col("o_orderkey").cast("int").alias("id"),
        F.year("o_orderdate").alias("season"),
        F.expr("cast(o_orderkey % 4 as int)").alias("gameType"),
        start.alias("startTimeUTC"),
        game_state.alias("gameState"),
        state.alias("gameScheduleState"),
        F.expr("o_orderkey % 6 = 0").alias("neutralSite"),
        F.when(F.expr("o_orderkey % 5 > 0"), F.struct(F.expr("concat('V', o_orderkey % 11)").alias("default"))).alias("venue"),
        _team("a", "o_custkey", "cast(o_orderkey % 7 as int)", "if(o_orderkey % 7 = 0, 'EVEN', concat(o_orderkey % 50, '.5'))").alias("awayTeam"),
        _team("h", "(o_orderkey % 32)", "cast(null as int)", "concat('-', o_orderkey % 90, '.25')").alias("homeTeam"),
        F.lit("not declared").alias("extra"),
    )
    part = F.expr("o_orderkey div 1000")  # a document holds games of so many keys at most
    days = table(spark, sf_dir, "orders").groupBy(F.to_date("o_orderdate").alias("day"), part).agg(F.collect_list(g).alias("games"))
    return days.select(F.array(F.struct(F.col("day").cast("string").alias("date"), "games")).alias("gameWeek"))


_LINKS = ("plays/{}.json", "shifts/{}")
_GAMES = """SELECT CAST(o_orderkey AS INTEGER) AS game_id, CAST(year(o_orderdate) AS INTEGER) AS season,
    strftime((o_orderdate + o_orderkey % 24 * INTERVAL 1 HOUR) AT TIME ZONE 'UTC' AT TIME ZONE 'America/New_York', '%Y-%m-%d') AS game_date,
    strftime((o_orderdate + o_orderkey % 24 * INTERVAL 1 HOUR) AT TIME ZONE 'UTC' AT TIME ZONE 'America/New_York', '%H:%M') AS "start_time_ET",
    CASE WHEN o_orderkey % 4 = 3 THEN 'P' ELSE 'R' END AS season_type, CASE WHEN o_orderstatus = 'F' THEN 'OK' ELSE o_orderstatus END AS game_schedule_state,
    CAST(o_custkey AS VARCHAR) AS away_team_id, CAST(o_orderkey % 7 AS INTEGER) AS away_score, 'a' || o_custkey AS away_abbreviation,
    CAST(NULL AS INTEGER) AS home_score, CAST(o_orderkey % 32 AS VARCHAR) AS home_team_id, 'h' || (o_orderkey % 32) AS home_abbreviation,
    'plays/' || o_orderkey || '.json' AS pbp_link, 'shifts/' || o_orderkey AS shift_link, o_orderpriority AS game_state
    FROM orders WHERE o_orderkey % 4 IN (2, 3)"""


@query(_GAMES)
def landed_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Games of schedule documents; games of other kinds than season and playoffs, and broken lines, go."""
    path = _land(_schedule_docs(spark, sf_dir, F.col("o_orderpriority")), broken=3)
    return schedule.games(landed.good(landed.schedules(spark, path)), *_LINKS).drop("start_time_utc")


@query(
    """SELECT CAST(o_orderkey AS INTEGER) AS game_id, CASE WHEN o_orderkey % 5 > 0 THEN 'V' || (o_orderkey % 11) END AS venue_name, o_orderkey % 6 = 0 AS "neutralSite",
    CASE WHEN o_orderkey % 3 > 0 THEN CAST(-(o_orderkey % 90) - 0.25 AS DOUBLE) END AS home_odds, CASE WHEN o_orderkey % 3 > 0 AND o_orderkey % 7 > 0 THEN CAST(o_orderkey % 50 + 0.5 AS DOUBLE) END AS away_odds FROM orders"""
)
def landed_odds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Venue and one provider's odds of each landed game; null where it offers none or no number."""
    path = _land(_schedule_docs(spark, sf_dir, F.col("o_orderpriority")), broken=3)
    return schedule.with_odds(landed.good(landed.schedules(spark, path)))


@query(
    f"""WITH done AS (SELECT * REPLACE (CASE game_state WHEN '1-URGENT' THEN 'OFF' ELSE 'FINAL' END AS game_state) FROM ({_GAMES}) WHERE game_schedule_state = 'OK' AND game_state IN ('1-URGENT', '2-HIGH')),
    known AS (SELECT * FROM done WHERE game_state = 'OFF' AND season < 1996)
    SELECT * FROM known UNION ALL
    SELECT * FROM done WHERE game_date >= coalesce((SELECT max(game_date) FROM known), '') AND game_id NOT IN (SELECT game_id FROM known)"""
)
def schedule_increment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A schedule table and the finished games on or after its latest date; what is older, or not finished, stays out."""
    state = F.expr("case o_orderpriority when '1-URGENT' then 'OFF' when '2-HIGH' then 'FINAL' else o_orderpriority end")
    path, at = _land(_schedule_docs(spark, sf_dir, state), broken=3), folder(spark)
    known = schedule.finished(seasons.load_schedule(spark, path, *_LINKS)).where("game_state = 'OFF' and season < 1996")
    known.write.parquet(at)
    seasons.update_schedule(spark, path, at, *_LINKS)
    return spark.read.schema(known.schema).parquet(at).drop("start_time_utc")


_WHO = """CAST(c_custkey AS VARCHAR) AS player_id, upper(c_name) AS "firstName", upper('of ' || c_mktsegment) AS "lastName",
    CAST(CASE WHEN c_custkey % 3 = 0 THEN 100 ELSE c_custkey % 90 END AS INTEGER) AS "sweaterNumber",
    CASE c_custkey % 4 WHEN 0 THEN 'G' WHEN 1 THEN 'D' ELSE 'C' END AS "positionCode", CASE WHEN c_custkey % 3 = 1 THEN 'R' ELSE 'L' END AS "shootsCatches",
    CASE WHEN c_custkey % 5 = 0 THEN '' ELSE 'state ' || c_nationkey END AS "birthStateProvince",
    CAST(c_custkey % 4 >= 2 AS INTEGER) AS "pos_F", CAST(c_custkey % 4 = 1 AS INTEGER) AS "pos_D", CAST(c_custkey % 4 = 0 AS INTEGER) AS "pos_G",
    CAST(c_custkey % 3 = 1 AS INTEGER) AS "hand_R", CAST(c_custkey % 3 <> 1 AS INTEGER) AS "hand_L\""""
_SHOWN = ["season", "team", "player_id", "firstName", "lastName", "sweaterNumber", "positionCode", "shootsCatches", "birthStateProvince", "pos_F", "pos_D", "pos_G", "hand_R", "hand_L"]


def _people(spark: SparkSession, sf_dir: str, key: str) -> DataFrame:
    said = lambda e: F.struct(F.expr(e).alias("default"))
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        "c_nationkey",
        F.col("c_custkey").cast("string").alias(key),
        said("c_name").alias("firstName"),
        said("concat('of ', c_mktsegment)").alias("lastName"),
        F.expr("if(c_custkey % 3 = 0, null, cast(c_custkey % 90 as int))").alias("sweaterNumber"),
        F.expr("case c_custkey % 4 when 0 then 'G' when 1 then 'D' else 'C' end").alias("code"),
        F.expr("if(c_custkey % 3 = 1, 'R', 'L')").alias("shootsCatches"),
        F.when(F.expr("c_custkey % 5 <> 0"), said("concat('state ', c_nationkey)")).alias("birthStateProvince"),
    )


def _roster_docs(spark: SparkSession, sf_dir: str, season: int) -> DataFrame:
    """Roster documents of a team and kind of position, as many as its people fill."""
    p = _people(spark, sf_dir, "id").withColumn("kind", F.expr("case code when 'G' then 'goalies' when 'D' then 'defensemen' else 'forwards' end"))
    person = F.struct("id", "firstName", "lastName", "sweaterNumber", F.col("code").alias("positionCode"), "shootsCatches", "birthStateProvince")
    docs = p.groupBy("c_nationkey", "kind", F.expr("c_custkey div 10000")).agg(F.collect_list(person).alias("people"))
    return docs.select(F.lit(season).alias("season"), F.concat(F.lit("N"), "c_nationkey").alias("team"), F.create_map("kind", "people").alias("positions"))


def _player_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    people = _people(spark, sf_dir, "playerId").withColumns({"currentTeamAbbrev": F.concat(F.lit("N"), "c_nationkey"), "position": F.col("code")})
    return people.drop("c_custkey", "c_nationkey", "code")


@query(f"SELECT CAST(20232024 AS BIGINT) AS season, 'N' || c_nationkey AS team, {_WHO} FROM customer")
def landed_roster(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Players of roster documents."""
    return schedule.roster(landed.good(landed.rosters(spark, _land(_roster_docs(spark, sf_dir, 20232024), broken=2)))).select(_SHOWN)


@query(f"SELECT season, 'N' || c_nationkey AS team, {_WHO} FROM customer, (VALUES (CAST(20222023 AS BIGINT)), (CAST(20232024 AS BIGINT))) AS s(season)")
def roster_compile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rosters of two seasons, one landed twice, and players landed by themselves, in one table without repeats."""
    first, second = (_roster_docs(spark, sf_dir, s) for s in (20222023, 20232024))
    parts = [schedule.roster(landed.good(landed.rosters(spark, _land(docs, broken=1)))) for docs in (first, second.union(second))]
    alone = schedule.additions(landed.good(landed.players(spark, _land(_player_docs(spark, sf_dir), broken=1))), 20232024)
    return schedule.compile_rosters([*parts, alone]).select(_SHOWN)


@query(f"SELECT CAST(2024 AS BIGINT) AS season, 'N' || c_nationkey AS team, {_WHO} FROM customer WHERE c_custkey NOT IN (SELECT s_suppkey FROM supplier)")
def landed_players(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Player documents for ids that the known roster (here the suppliers' keys) lacks."""
    found = schedule.additions(landed.good(landed.players(spark, _land(_player_docs(spark, sf_dir), broken=1))), 2024)
    known = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("string").alias("player_id"))
    return found.join(known, "player_id", "left_anti").select(_SHOWN)


_CLOCK = "(event_id % 20) || ':' || lpad(CAST(event_id % 60 AS VARCHAR), 2, '0')"


@query(
    f"""SELECT CAST(user_id AS INTEGER) AS game_id, CAST(20232024 AS INTEGER) AS season, CAST(event_id AS INTEGER) AS event_idx, CAST(1 + event_id % 3 AS INTEGER) AS period,
    CASE event_type WHEN 'purchase' THEN 'GOAL' WHEN 'click' THEN 'SHOT' WHEN 'error' THEN 'PENALTY' WHEN 'signup' THEN 'FACEOFF' ELSE 'MISSED_SHOT' END AS event_type,
    CASE WHEN event_id % 5 = 0 THEN NULL WHEN event_id % 2 = 0 THEN 'Wrist' ELSE 'Tip-In' END AS secondary_type, CASE WHEN event_id % 2 = 0 THEN 'home' ELSE 'away' END AS event_team_type,
    CASE WHEN event_id % 4 = 0 THEN NULL ELSE CAST(event_id % 90 AS DOUBLE) END AS x, CAST(event_id % 20 * 60 + event_id % 60 AS INTEGER) AS period_seconds,
    CAST(event_id % 20 * 60 + event_id % 60 + event_id % 3 * 1200 AS INTEGER) AS game_seconds, CASE WHEN user_id % 2 = 0 THEN 'R' ELSE 'P' END AS season_type, CAST(NULL AS VARCHAR) AS "penaltyTypeCode"
    FROM events"""
)
def landed_plays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Play-by-play documents, one for each game, to events with their clock."""
    details = F.struct(
        F.expr("if(event_id % 2 = 0, 'h', 'a')").alias("eventOwnerTeamId"),
        F.expr("if(event_id % 5 = 0, null, if(event_id % 2 = 0, 'wrist', 'tip-in'))").alias("shotType"),
        F.expr("if(event_id % 4 = 0, null, cast(event_id % 90 as double))").alias("xCoord"),
        F.lit(1).alias("not_declared"),
    )
    play = F.struct(
        F.col("event_id").alias("eventId"),
        F.col("event_id").alias("sortOrder"),
        F.expr("case event_type when 'purchase' then 'goal' when 'click' then 'shot-on-goal' when 'error' then 'penalty' when 'signup' then 'faceoff' else 'missed-shot' end").alias("typeDescKey"),
        F.expr("format_string('%d:%02d', event_id % 20, event_id % 60)").alias("timeInPeriod"),
        F.struct(F.expr("1 + event_id % 3").alias("number"), F.lit("REG").alias("periodType")).alias("periodDescriptor"),
        details.alias("details"),
    )
    docs = table(spark, sf_dir, "events").groupBy("user_id").agg(F.collect_list(play).alias("plays"))
    team = lambda c: F.struct(F.lit(c).alias("id"), F.lit(c.upper()).alias("abbrev"))
    docs = docs.select(F.col("user_id").alias("id"), F.lit(20232024).alias("season"), F.expr("cast(2 + user_id % 2 as int)").alias("gameType"), team("a").alias("awayTeam"), team("h").alias("homeTeam"), "plays")
    out = game.clock(game.align(landed.pbp(spark, _land(docs, broken=2))))
    return out.select("game_id", "season", "event_idx", "period", "event_type", "secondary_type", "event_team_type", "x", F.col("period_seconds").cast("int").alias("period_seconds"), F.col("game_seconds").cast("int").alias("game_seconds"), "season_type", "penaltyTypeCode")


@query(
    """SELECT CAST(user_id AS INTEGER) AS game_id, CAST(event_id AS VARCHAR) AS player_id, upper(event_type || ' of ' || user_id) AS player_name, CAST(1 + event_id % 3 AS INTEGER) AS period,
    CAST(event_id % 15 * 60 + event_id % 60 AS BIGINT) AS period_start_seconds, CAST(event_id % 15 * 60 + event_id % 60 + event_id % 4 * 30 AS BIGINT) AS period_end_seconds,
    CAST(event_id % 15 * 60 + event_id % 60 + event_id % 3 * 1200 AS BIGINT) AS game_start_seconds
    FROM events WHERE event_id % 4 > 0 AND event_id % 9 > 0"""
)
def landed_shifts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shift documents, one for each game, to intervals in seconds; shifts of no length or without a clock go."""
    clock = lambda s: F.expr(f"format_string('%d:%02d', ({s}) div 60, ({s}) % 60)")
    start = "event_id % 15 * 60 + event_id % 60"
    shift = F.struct(
        F.col("user_id").alias("gameId"),
        F.lit("7").alias("teamId"),
        F.col("event_id").cast("string").alias("playerId"),
        F.col("event_type").alias("firstName"),
        F.concat(F.lit("of "), "user_id").alias("lastName"),
        F.expr("1 + event_id % 3").alias("period"),
        clock(start).alias("startTime"),
        F.when(F.expr("event_id % 9 = 0"), "").otherwise(clock(f"{start} + event_id % 4 * 30")).alias("endTime"),
    )
    twice = table(spark, sf_dir, "events").union(table(spark, sf_dir, "events").where("event_id % 2 = 0"))
    docs = twice.groupBy("user_id").agg(F.collect_list(shift).alias("data")).select("data")
    out = onice.normalise_shifts(landed.shifts(spark, _land(docs, broken=2)))
    return out.select("game_id", "player_id", "player_name", "period", "period_start_seconds", "period_end_seconds", "game_start_seconds")


@query("SELECT event_id, user_id, event_type FROM events")
def stream_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events that land twice, read as a stream by the package's own source, each once by a state that forgets."""
    lines.register(spark)
    path, out = folder(spark), folder(spark)
    e = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "ts")
    e.select(F.to_json(F.struct("*")).alias("value")).union(e.select(F.to_json(F.struct("*")).alias("value"))).write.text(path)
    landing = spark.readStream.format("landed").load(path)
    rows = incremental.once(landed.parsed(landing, "event_id long, user_id long, event_type string, ts timestamp"), ["event_id"], "ts", "1 day")
    rows.select("event_id", "user_id", "event_type").writeStream.format("parquet").option("checkpointLocation", folder(spark)).option("path", out).trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema("event_id long, user_id long, event_type string").parquet(out)


@query("SELECT 'players' AS feed, CAST(count(*) + 5 AS BIGINT) AS documents, CAST(5 AS BIGINT) AS bad, CAST(5 AS BIGINT) AS set_aside, CAST(count(*) AS BIGINT) AS loaded FROM customer")
def load_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of a load, observed while it runs, and the side table of its bad records."""
    docs = _people(spark, sf_dir, "playerId").drop("c_custkey", "c_nationkey", "code")
    seen_docs, seen = landed.counted(landed.players(spark, _land(docs, broken=5)), "players")
    everything, aside = folder(spark), folder(spark)
    seen_docs.write.parquet(everything)
    loaded = landed.set_aside(spark.read.parquet(everything), aside)
    row = spark.createDataFrame([("players", seen.get["documents"], seen.get["bad"])], "feed string, documents long, bad long")
    counts = loaded.agg(F.count("*").alias("loaded")).crossJoin(spark.read.parquet(aside).agg(F.count("*").alias("set_aside")))
    return row.crossJoin(counts).select("feed", "documents", "bad", "set_aside", "loaded")


@query()
def load_speed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, games and seconds of each batch of a stream that loads the events' files."""
    path, loads = folder(spark), progress.Loads()
    table(spark, sf_dir, "events").repartition(4).select(F.to_json(F.struct("event_id", "user_id")).alias("value")).write.text(path)
    spark.streams.addListener(loads)
    try:
        docs = progress.measured(incremental.stream(spark, path, "event_id long, user_id long", files=2), "user_id")
        docs.writeStream.queryName("events").format("parquet").option("checkpointLocation", folder(spark)).option("path", folder(spark)).trigger(availableNow=True).start().awaitTermination()
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
        return loads.take(spark)
    finally:
        spark.streams.removeListener(loads)
