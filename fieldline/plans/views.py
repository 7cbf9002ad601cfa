"""Views that re-express the driver tables in the sports data model.

Mapping (one row of ``lineitem`` is one pitch):

* game            = order            (``game_pk = l_orderkey``, ``game_date = o_orderdate``)
* batter          = the order's customer; pitcher = the line's supplier
* home / away team = customer nation / supplier nation
* at-bat number   = line number (also the inning); pitch number = part key
* terminal event  = a pitch outcome picked from the line's quantity; return flag ``N`` means the
  pitch ended nothing. Launch and estimate columns exist for balls in play only.

All derived doubles are integers or small binary fractions so that sums are exact and the Spark
results equal the SQL oracle bit for bit, whatever the summation order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldline.session import table_path

# Outcome chosen by quantity mod 19 (position in this list); '' is a blank event.
OUTCOME_CYCLE = [
    "single", "double", "triple", "home_run", "walk", "intent_walk", "hit_by_pitch", "sac_bunt",
    "sac_fly", "sac_fly_error", "catcher_interf", "strikeout", "field_out", "force_out",
    "grounded_into_double_play", "double_play", "fielders_choice_out", "triple_play", "",
]
IN_PLAY = [
    "single", "double", "triple", "home_run", "sac_fly", "field_out", "force_out",
    "grounded_into_double_play", "double_play", "fielders_choice_out", "triple_play",
]
PITCH_TYPES = {0: ("FF", "4-Seam Fastball"), 1: ("SL", "Slider"), 2: ("CU", "Curveball"),
               3: ("CH", "Changeup"), 4: ("SI", "Sinker")}

# Columns that, in this order, give every pitch of a game a unique position.
PITCH_ORDER = ["at_bat_number", "pitch_number", "pitcher", "l_quantity", "l_extendedprice",
               "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


#: Pitches (or rows made from them) that one task sorts or groups at most, on average.
PITCHES_PER_TASK = 250_000


def tasks_for(spark: SparkSession, sf_dir: str, name: str) -> int:
    """Partitions for rows of a table, from its exact row count (Parquet footers only).

    Left to AQE, shuffle partitions are joined up to 64 MB of compressed columns, which are millions of
    rows once they are sorted; with a fixed number of partitions a task grows with the table.
    """
    rows = load(spark, sf_dir, name).count()
    return max(spark.sparkContext.defaultParallelism, -(-rows // PITCHES_PER_TASK))


def _icast(c: Column) -> Column:
    return F.round(c).cast("int")


def pitch_view(spark: SparkSession, sf_dir: str, batch: tuple[int, int] | None = None) -> DataFrame:
    """One row per pitch.

    ``batch`` (number, of how many) is for rollups by game that are stored in batches: the pitches of every so-manyth
    game, by a hash of the game. They meet their supplier before they are dealt by game, so that a supplier table too
    large to broadcast doesn't deal them once more, away from their game.
    """
    li = load(spark, sf_dir, "lineitem")
    o = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    c = load(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal")
    s = load(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey", "s_acctbal")
    n = load(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    hn = n.select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("home_team"))
    an = n.select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("away_team"))
    # The order gets its customer before its pitches, so that pitches are dealt once, by game.
    tasks = tasks_for(spark, sf_dir, "lineitem")
    if batch:
        number, batches = batch
        li, o = (t.where(F.pmod(F.xxhash64(k), F.lit(batches)) == number) for t, k in ((li, "l_orderkey"), (o, "o_orderkey")))
        tasks = max(spark.sparkContext.defaultParallelism, -(-tasks // batches))
    games = o.join(c, F.col("o_custkey") == F.col("c_custkey")).join(hn, "c_nationkey")
    own = F.col("l_suppkey") == F.col("s_suppkey")
    pitches = (li.join(s, own) if batch else li).repartition(tasks, "l_orderkey")
    df = pitches.join(games.repartition(tasks, "o_orderkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    df = (df if batch else df.join(s, own)).join(an, "s_nationkey")
    qty = _icast(F.col("l_quantity"))
    disc = _icast(F.col("l_discount") * 100)
    tax = _icast(F.col("l_tax") * 100)
    outcome = F.element_at(F.array(*[F.lit(e) for e in OUTCOME_CYCLE]), (qty % 19) + 1)
    events = F.when(F.col("l_returnflag") != "N", outcome)
    in_play = events.isin(IN_PLAY)
    launch_angle = F.when(in_play, (tax * 6 - 6).cast("double"))
    ptype_idx = F.col("l_partkey") % 6
    pitch_type = F.coalesce(
        *[F.when(ptype_idx == k, F.lit(v[0])) for k, v in PITCH_TYPES.items()],
        F.when(F.col("l_linenumber") % 2 == 0, F.lit("")),
    )
    pitch_name = F.coalesce(*[F.when(ptype_idx == k, F.lit(v[1])) for k, v in PITCH_TYPES.items()])
    kind = (
        F.when(F.col("l_returnflag") != "N", "X")
        .when(F.col("l_linestatus") == "F", "S")
        .otherwise("B")
    )
    bat_score = F.col("l_linenumber") - 1
    return df.select(
        F.col("l_orderkey").alias("game_pk"),
        F.col("o_orderdate").cast("date").alias("game_date"),
        F.year("o_orderdate").alias("game_year"),
        F.col("o_custkey").alias("batter"),
        F.col("l_suppkey").alias("pitcher"),
        F.col("c_name").alias("batter_name"),
        F.col("s_name").alias("player_name"),
        F.col("l_linenumber").alias("at_bat_number"),
        F.col("l_partkey").alias("pitch_number"),
        F.col("l_linenumber").alias("inning"),
        F.when(F.col("l_linestatus") == "O", "Bot").otherwise("Top").alias("inning_topbot"),
        "home_team",
        "away_team",
        F.col("c_nationkey").alias("home_nationkey"),
        F.when(F.col("c_acctbal") >= 5000, "L").otherwise("R").alias("stand"),
        F.when(F.col("s_acctbal") >= 5000, "L").otherwise("R").alias("p_throws"),
        events.alias("events"),
        kind.alias("type"),
        F.when(in_play, "hit_into_play")
        .when(kind == "S", "called_strike")
        .when(kind == "B", "ball")
        .otherwise("swinging_strike")
        .alias("description"),
        pitch_type.alias("pitch_type"),
        pitch_name.alias("pitch_name"),
        (F.lit(30.0) + (F.round(F.col("l_extendedprice")).cast("long") % 71)).alias("release_speed"),
        (F.lit(1800.0) + (F.col("l_partkey") % 1000)).alias("release_spin_rate"),
        (((F.col("l_partkey") % 9) - 4) / F.lit(4.0)).alias("pfx_x"),
        (((F.col("l_suppkey") % 9) - 4) / F.lit(4.0)).alias("pfx_z"),
        (F.lit(5.0) + F.col("l_linenumber") / F.lit(4.0)).alias("release_extension"),
        F.when(in_play, F.lit(70.0) + disc * 4).alias("launch_speed"),
        launch_angle.alias("launch_angle"),
        F.when(in_play, (qty % 6) + 1).alias("launch_speed_angle"),
        F.when(in_play, tax / F.lit(8.0)).alias("estimated_woba_using_speedangle"),
        F.when(in_play & (F.col("l_linenumber") != 3), disc / F.lit(4.0)).alias(
            "estimated_slg_using_speedangle"
        ),
        F.when(in_play, disc / F.lit(16.0)).alias("estimated_ba_using_speedangle"),
        F.when(in_play, F.when(launch_angle >= 25, "fly_ball")
               .when(launch_angle >= 10, "line_drive").otherwise("ground_ball")).alias("bb_type"),
        bat_score.alias("bat_score"),
        (bat_score + (tax % 3) - 1).alias("post_bat_score"),
        (((tax % 3) - 1) / F.lit(8.0)).alias("delta_run_exp"),
        F.when(F.col("l_linenumber") != 1,
               (F.lit(20) + (F.col("o_custkey") + F.col("l_linenumber")) % 17).cast("double"))
        .alias("age_bat"),
        F.col("l_shipdate").alias("_loaded_at"),
        "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
        "l_shipdate",
    )


PITCH_VIEW_SQL = """
pitches AS (
  SELECT
    l.l_orderkey AS game_pk,
    CAST(o.o_orderdate AS DATE) AS game_date,
    CAST(year(o.o_orderdate) AS INTEGER) AS game_year,
    o.o_custkey AS batter,
    l.l_suppkey AS pitcher,
    c.c_name AS batter_name,
    s.s_name AS player_name,
    l.l_linenumber AS at_bat_number,
    l.l_partkey AS pitch_number,
    l.l_linenumber AS inning,
    CASE WHEN l.l_linestatus = 'O' THEN 'Bot' ELSE 'Top' END AS inning_topbot,
    hn.n_name AS home_team,
    an.n_name AS away_team,
    c.c_nationkey AS home_nationkey,
    CASE WHEN c.c_acctbal >= 5000 THEN 'L' ELSE 'R' END AS stand,
    CASE WHEN s.s_acctbal >= 5000 THEN 'L' ELSE 'R' END AS p_throws,
    l.ev AS events,
    l.kind AS type,
    CASE WHEN l.in_play THEN 'hit_into_play' WHEN l.kind = 'S' THEN 'called_strike'
         WHEN l.kind = 'B' THEN 'ball' ELSE 'swinging_strike' END AS description,
    CASE l.l_partkey % 6 WHEN 0 THEN 'FF' WHEN 1 THEN 'SL' WHEN 2 THEN 'CU' WHEN 3 THEN 'CH'
         WHEN 4 THEN 'SI' ELSE CASE WHEN l.l_linenumber % 2 = 0 THEN '' END END AS pitch_type,
    CASE l.l_partkey % 6 WHEN 0 THEN '4-Seam Fastball' WHEN 1 THEN 'Slider'
         WHEN 2 THEN 'Curveball' WHEN 3 THEN 'Changeup' WHEN 4 THEN 'Sinker' END AS pitch_name,
    CAST(30 + CAST(round(l.l_extendedprice) AS BIGINT) % 71 AS DOUBLE) AS release_speed,
    CAST(1800 + l.l_partkey % 1000 AS DOUBLE) AS release_spin_rate,
    CAST((l.l_partkey % 9) - 4 AS DOUBLE) / 4 AS pfx_x,
    CAST((l.l_suppkey % 9) - 4 AS DOUBLE) / 4 AS pfx_z,
    5 + CAST(l.l_linenumber AS DOUBLE) / 4 AS release_extension,
    CASE WHEN l.in_play THEN CAST(70 + l.disc * 4 AS DOUBLE) END AS launch_speed,
    CASE WHEN l.in_play THEN CAST(l.tax * 6 - 6 AS DOUBLE) END AS launch_angle,
    CASE WHEN l.in_play THEN (l.qty % 6) + 1 END AS launch_speed_angle,
    CASE WHEN l.in_play THEN CAST(l.tax AS DOUBLE) / 8 END AS estimated_woba_using_speedangle,
    CASE WHEN l.in_play AND l.l_linenumber <> 3 THEN CAST(l.disc AS DOUBLE) / 4 END
      AS estimated_slg_using_speedangle,
    CASE WHEN l.in_play THEN CAST(l.disc AS DOUBLE) / 16 END AS estimated_ba_using_speedangle,
    CASE WHEN l.in_play THEN CASE WHEN l.tax * 6 - 6 >= 25 THEN 'fly_ball'
         WHEN l.tax * 6 - 6 >= 10 THEN 'line_drive' ELSE 'ground_ball' END END AS bb_type,
    l.l_linenumber - 1 AS bat_score,
    l.l_linenumber - 1 + (l.tax % 3) - 1 AS post_bat_score,
    CAST((l.tax % 3) - 1 AS DOUBLE) / 8 AS delta_run_exp,
    CASE WHEN l.l_linenumber <> 1
         THEN CAST(20 + (o.o_custkey + l.l_linenumber) % 17 AS DOUBLE) END AS age_bat,
    l.l_shipdate AS _loaded_at,
    l.l_quantity, l.l_extendedprice, l.l_discount, l.l_tax, l.l_returnflag, l.l_linestatus,
    l.l_shipdate
  FROM (
    SELECT *, coalesce(ev IN ('single','double','triple','home_run','sac_fly','field_out',
                     'force_out','grounded_into_double_play','double_play',
                     'fielders_choice_out','triple_play'), false) AS in_play,
           CASE WHEN l_returnflag <> 'N' THEN 'X' WHEN l_linestatus = 'F' THEN 'S' ELSE 'B' END
             AS kind
    FROM (
      SELECT *, CASE WHEN l_returnflag <> 'N' THEN
               (['single','double','triple','home_run','walk','intent_walk','hit_by_pitch',
                 'sac_bunt','sac_fly','sac_fly_error','catcher_interf','strikeout','field_out',
                 'force_out','grounded_into_double_play','double_play','fielders_choice_out',
                 'triple_play',''])[(qty % 19) + 1] END AS ev
      FROM (
        SELECT *, CAST(round(l_quantity) AS INTEGER) AS qty,
               CAST(round(l_discount * 100) AS INTEGER) AS disc,
               CAST(round(l_tax * 100) AS INTEGER) AS tax
        FROM lineitem
      )
    )
  ) l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN nation hn ON c.c_nationkey = hn.n_nationkey
  JOIN nation an ON s.s_nationkey = an.n_nationkey
)
"""


# --- team game log: one row per order, home = customer nation, visitor = another nation ------
# Side 'h' counts the pitches of lines with status 'O', side 'v' those with status 'F'.
SIDE_STATS = {
    "AB": "ab", "H": "h", "x2B": "x2b", "x3B": "x3b", "HR": "hr", "BB": "bb", "runs": "runs",
    "SB": "sb", "CS": "cs", "ERR": "err",
}


def game_log_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    from fieldline.functions.constants import HIT_EVENTS, NON_AB_EVENTS, WALK_EVENTS
    from fieldline.functions.scalar import non_empty

    p = pitch_view(spark, sf_dir)
    ev = F.col("events")
    pa = non_empty(ev)
    runs = F.greatest(F.col("post_bat_score") - F.col("bat_score"), F.lit(0))
    preds = {
        "AB": pa & ~ev.isin(NON_AB_EVENTS), "H": pa & ev.isin(HIT_EVENTS),
        "x2B": pa & (ev == "double"), "x3B": pa & (ev == "triple"),
        "HR": pa & (ev == "home_run"), "BB": pa & ev.isin(WALK_EVENTS),
        "SB": pa & (ev == "sac_bunt"), "CS": pa & (ev == "catcher_interf"),
        "ERR": pa & (ev == "sac_fly_error"),
    }
    aggs = []
    for side, status in (("h", "O"), ("v", "F")):
        on_side = F.col("l_linestatus") == status
        for stat, pred in preds.items():
            aggs.append(F.count_if(on_side & pred).alias(f"{stat}_{side}"))
        aggs.append(F.coalesce(F.sum(F.when(on_side & pa, runs)), F.lit(0)).cast("long")
                    .alias(f"runs_{side}"))
    g = p.groupBy(
        "game_pk", F.col("game_date").alias("date"), F.col("game_year").alias("season"),
        F.col("home_team").alias("team_h"), "home_nationkey",
    ).agg(*aggs)
    nation = load(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("_vkey"), F.col("n_name").alias("team_v"))
    vkey = (F.col("home_nationkey") + 1 + F.col("game_pk") % 24) % 25
    g = g.withColumn("_vkey", vkey.cast("int")).join(nation, "_vkey").drop("_vkey",
                                                                          "home_nationkey")
    from pyspark.sql import Window

    g = g.repartition(tasks_for(spark, sf_dir, "orders"), "date", "team_h", "team_v")
    pair_day = Window.partitionBy("date", "team_h", "team_v")
    num = F.when(F.count(F.lit(1)).over(pair_day) > 1,
                 F.row_number().over(pair_day.orderBy("game_pk"))).otherwise(0)
    return g.select(
        "game_pk", "date", "season", num.alias("game_num"), "team_h", "team_v",
        F.col("runs_h").alias("home_score"), F.col("runs_v").alias("visiting_score"),
        *[f"{s}_{side}" for side in ("h", "v") for s in SIDE_STATS],
    )


def _side_sql(side: str, status: str) -> str:
    from fieldline.functions.constants import HIT_EVENTS, NON_AB_EVENTS, WALK_EVENTS

    q = lambda xs: ", ".join(f"'{x}'" for x in xs)
    pa = f"l_linestatus = '{status}' AND events IS NOT NULL AND events <> ''"
    preds = {
        "AB": f"events NOT IN ({q(NON_AB_EVENTS)})", "H": f"events IN ({q(HIT_EVENTS)})",
        "x2B": "events = 'double'", "x3B": "events = 'triple'", "HR": "events = 'home_run'",
        "BB": f"events IN ({q(WALK_EVENTS)})", "SB": "events = 'sac_bunt'",
        "CS": "events = 'catcher_interf'", "ERR": "events = 'sac_fly_error'",
    }
    parts = [f"count(*) FILTER (WHERE {pa} AND {p}) AS {s}_{side}" for s, p in preds.items()]
    parts.append(f"CAST(coalesce(sum(greatest(post_bat_score - bat_score, 0)) FILTER (WHERE {pa}),"
                 f" 0) AS BIGINT) AS runs_{side}")
    return ",\n    ".join(parts)


GAME_LOG_SQL = f"""
gl0 AS (
  SELECT game_pk, game_date AS date, game_year AS season, home_team AS team_h, home_nationkey,
    {_side_sql('h', 'O')},
    {_side_sql('v', 'F')}
  FROM pitches GROUP BY game_pk, game_date, game_year, home_team, home_nationkey
),
gl1 AS (
  SELECT gl0.*, n.n_name AS team_v FROM gl0
  JOIN nation n ON n.n_nationkey = (gl0.home_nationkey + 1 + gl0.game_pk % 24) % 25
),
games AS (
  SELECT game_pk, date, season,
    CASE WHEN count(*) OVER (PARTITION BY date, team_h, team_v) > 1
         THEN row_number() OVER (PARTITION BY date, team_h, team_v ORDER BY game_pk)
         ELSE 0 END AS game_num,
    team_h, team_v, runs_h AS home_score, runs_v AS visiting_score,
    {', '.join(f'{s}_h' for s in SIDE_STATS)},
    {', '.join(f'{s}_v' for s in SIDE_STATS)}
  FROM gl1
)"""


def odds_log_view(spark: SparkSession, sf_dir: str, games: DataFrame | None = None) -> DataFrame:
    """The odds site's per-team game log, derived from the games (each team's own line).

    ``games`` are rows of ``game_log_view`` that are there already.
    """
    g = game_log_view(spark, sf_dir) if games is None else games
    line = ((F.col("game_pk") * 37) % 401 - 200).cast("double")
    total = (F.lit(7.5) + F.col("game_pk") % 5).cast("double")
    game = F.when(F.col("game_pk") % 10 == 0, "POST").otherwise("REG")
    ou = F.when(F.col("home_score") + F.col("visiting_score") > total, "O").otherwise("U")
    common = [F.col("season"), F.col("date").alias("Date"), game.alias("Game"),
              total.alias("Total"), ou.alias("OU"), F.col("game_pk").alias("source_row")]
    side = lambda team, own: F.struct(F.col(team).alias("team_source"), *common, own.alias("Line"))
    return g.select(F.inline(F.array(side("team_h", line), side("team_v", -line))))  # one pass over the games


ODDS_LOG_SQL = """
odds_log AS (
  SELECT team_h AS team_source, season, date AS "Date",
    CASE WHEN game_pk % 10 = 0 THEN 'POST' ELSE 'REG' END AS "Game",
    CAST(7.5 + game_pk % 5 AS DOUBLE) AS "Total",
    CASE WHEN home_score + visiting_score > 7.5 + game_pk % 5 THEN 'O' ELSE 'U' END AS "OU",
    game_pk AS source_row, CAST((game_pk * 37) % 401 - 200 AS DOUBLE) AS "Line"
  FROM games
  UNION ALL
  SELECT team_v, season, date,
    CASE WHEN game_pk % 10 = 0 THEN 'POST' ELSE 'REG' END,
    CAST(7.5 + game_pk % 5 AS DOUBLE),
    CASE WHEN home_score + visiting_score > 7.5 + game_pk % 5 THEN 'O' ELSE 'U' END,
    game_pk, -CAST((game_pk * 37) % 401 - 200 AS DOUBLE)
  FROM games
)"""
