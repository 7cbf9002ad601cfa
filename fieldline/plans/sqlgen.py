"""Small generators for the oracle SQL text (window sums, rates, rounding).

Only oracle text is produced here; the Spark side is built with the DataFrame API.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from fieldline.functions import constants as K

PITCH_ORDER_SQL = ("at_bat_number, pitch_number, pitcher, l_quantity, l_extendedprice, "
                   "l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate")
PA = "(events IS NOT NULL AND events <> '')"
BATTED = f"({PA} AND launch_speed IS NOT NULL)"


def qlist(values: Iterable[str]) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def dbl(x: float) -> str:
    return f"CAST('{x!r}' AS DOUBLE)"


def rnd(expr: str, n: int) -> str:
    """ROUND with half-up on the shortest decimal form of the double (Spark's rule)."""
    return f"CAST(round(CAST(CAST(CAST({expr} AS DOUBLE) AS VARCHAR) AS DECIMAL(38,18)), {n}) AS DOUBLE)"


def sdiv(num: str, den: str) -> str:
    return f"(CAST({num} AS DOUBLE) / CAST(NULLIF({den}, 0) AS DOUBLE))"


def lagged_sum(col: str, w: int, part: str, order: str, integral: bool, strict: bool = False):
    frame = f"OVER (PARTITION BY {part} ORDER BY {order} ROWS BETWEEN {w} PRECEDING AND 1 PRECEDING)"
    s = f"sum({col}) {frame}"
    s = f"CAST({s} AS BIGINT)" if integral else f"CAST({s} AS DOUBLE)"
    need = w if strict else 1
    return f"CASE WHEN count({col}) {frame} >= {need} THEN {s} END"


def batter_game_cte(name: str = "bg") -> str:
    o = PITCH_ORDER_SQL
    return f"""
{name}0 AS (
  SELECT batter AS mlbam_id, game_date, game_pk,
    count(*) FILTER (WHERE {PA}) AS _pa,
    first(inning_topbot ORDER BY {o}) AS _topbot,
    first(home_team ORDER BY {o}) AS _home_team,
    first(away_team ORDER BY {o}) AS _away_team,
    first(stand ORDER BY {o}) AS stand,
    first(p_throws ORDER BY {o}) AS p_throws,
    first(pitcher ORDER BY {o}) AS opp_pitcher_id,
    CAST(min(inning) = 1 AS INTEGER) AS opp_is_starter,
    first(age_bat ORDER BY {o}) FILTER (WHERE age_bat IS NOT NULL) AS age,
    count(*) FILTER (WHERE {PA} AND events NOT IN ({qlist(K.NON_AB_EVENTS)})) AS ab,
    count(*) FILTER (WHERE {PA} AND events IN ({qlist(K.HIT_EVENTS)})) AS h,
    count(*) FILTER (WHERE {PA} AND events = 'double') AS x2b,
    count(*) FILTER (WHERE {PA} AND events = 'triple') AS x3b,
    count(*) FILTER (WHERE {PA} AND events = 'home_run') AS hr,
    count(*) FILTER (WHERE {PA} AND events IN ({qlist(K.WALK_EVENTS)})) AS bb,
    count(*) FILTER (WHERE {PA} AND events = 'hit_by_pitch') AS hbp,
    count(*) FILTER (WHERE {PA} AND events = 'sac_fly') AS sf,
    count(*) FILTER (WHERE {BATTED}) AS batted_balls,
    coalesce(sum(launch_speed) FILTER (WHERE {BATTED}), CAST(0 AS DOUBLE)) AS ev_sum,
    count(*) FILTER (WHERE {BATTED} AND launch_speed >= {K.HARD_HIT_MIN_SPEED}) AS hard_hits,
    count(*) FILTER (WHERE {BATTED} AND launch_angle >= {K.SWEET_SPOT_MIN_ANGLE}
                     AND launch_angle <= {K.SWEET_SPOT_MAX_ANGLE}) AS sweet_spots,
    count(*) FILTER (WHERE {BATTED} AND launch_speed_angle = {K.BARREL_CODE}) AS barrels,
    coalesce(sum(estimated_woba_using_speedangle) FILTER (WHERE {BATTED}), CAST(0 AS DOUBLE))
      AS est_woba,
    coalesce(sum(estimated_slg_using_speedangle) FILTER (WHERE {BATTED}), CAST(0 AS DOUBLE))
      AS est_slg
  FROM pitches
  WHERE batter IS NOT NULL AND game_date IS NOT NULL AND game_pk IS NOT NULL
  GROUP BY 1, 2, 3
  HAVING count(*) FILTER (WHERE {PA}) > 0
),
{name} AS (
  SELECT mlbam_id, game_date, game_pk,
    CASE WHEN _topbot = 'Bot' THEN _away_team ELSE _home_team END AS opponent,
    CAST(_topbot = 'Bot' AS INTEGER) AS is_home,
    stand, p_throws, opp_pitcher_id, opp_is_starter, age,
    ab, h, x2b, x3b, hr, bb, hbp, sf,
    CASE WHEN p_throws = 'R' THEN hr ELSE 0 END AS hr_vs_r,
    CASE WHEN p_throws = 'R' THEN ab ELSE 0 END AS ab_vs_r,
    CASE WHEN p_throws = 'L' THEN hr ELSE 0 END AS hr_vs_l,
    CASE WHEN p_throws = 'L' THEN ab ELSE 0 END AS ab_vs_l,
    batted_balls, ev_sum, hard_hits, sweet_spots, barrels, est_woba, est_slg
  FROM {name}0
)"""


def outs_case(col: str = "events") -> str:
    whens = " ".join(f"WHEN {col} = '{k}' THEN {v}" for k, v in K.OUTS_BY_EVENT.items())
    return f"CASE {whens} ELSE 0 END"


def pitcher_game_cte(name: str = "pg") -> str:
    o = PITCH_ORDER_SQL
    return f"""
{name}0 AS (
  SELECT pitcher AS mlbam_id, game_date, game_pk,
    count(*) FILTER (WHERE {PA}) AS bfp,
    first(inning_topbot ORDER BY {o}) AS _topbot,
    first(home_team ORDER BY {o}) AS _home_team,
    first(away_team ORDER BY {o}) AS _away_team,
    CAST(min(inning) = 1 AS INTEGER) AS gs,
    CAST(coalesce(sum(CASE WHEN {PA} THEN {outs_case()} ELSE 0 END), 0) AS BIGINT) AS outs,
    count(*) FILTER (WHERE {PA} AND events IN ({qlist(K.HIT_EVENTS)})) AS h,
    count(*) FILTER (WHERE {PA} AND events IN ({qlist(K.WALK_EVENTS)})) AS bb,
    count(*) FILTER (WHERE {PA} AND events = 'strikeout') AS so,
    count(*) FILTER (WHERE {PA} AND events = 'home_run') AS hr,
    CAST(coalesce(sum(greatest(post_bat_score - bat_score, 0)) FILTER (WHERE {PA}), 0)
         AS BIGINT) AS r,
    count(*) FILTER (WHERE {PA} AND events = 'double') AS x2b,
    count(*) FILTER (WHERE {PA} AND events = 'triple') AS x3b,
    count(*) FILTER (WHERE {BATTED} AND bb_type = 'fly_ball') AS fly_balls,
    count(*) FILTER (WHERE {BATTED}) AS batted_balls_allowed
  FROM pitches
  WHERE pitcher IS NOT NULL AND game_date IS NOT NULL AND game_pk IS NOT NULL
  GROUP BY 1, 2, 3
  HAVING count(*) FILTER (WHERE {PA}) > 0
),
{name} AS (
  SELECT mlbam_id, game_date, game_pk,
    CASE WHEN _topbot = 'Top' THEN _away_team ELSE _home_team END AS opponent,
    CAST(_topbot = 'Top' AS INTEGER) AS is_home_pitcher,
    gs, CAST(outs AS DOUBLE) / 3 AS ip, outs, bfp, h, bb, so, hr, r, r AS er,
    x2b, x3b, fly_balls, batted_balls_allowed
  FROM {name}0
)"""


BATTER_GAME_COLUMNS = [
    "mlbam_id", "game_date", "game_pk", "opponent", "is_home", "stand", "p_throws",
    "opp_pitcher_id", "opp_is_starter", "age", "ab", "h", "x2b", "x3b", "hr", "bb", "hbp", "sf",
    "hr_vs_r", "ab_vs_r", "hr_vs_l", "ab_vs_l", "batted_balls", "ev_sum", "hard_hits",
    "sweet_spots", "barrels", "est_woba", "est_slg",
]
BATTER_FLOAT = {"ev_sum", "est_woba", "est_slg"}
PITCHER_GAME_COLUMNS = [
    "mlbam_id", "game_date", "game_pk", "opponent", "is_home_pitcher", "gs", "ip", "outs", "bfp",
    "h", "bb", "so", "hr", "r", "er", "x2b", "x3b", "fly_balls", "batted_balls_allowed",
]


def batter_rates_sql(w: int) -> list[str]:
    g = lambda c: f"rollsum_{c}_{w}"
    pa = f"({g('ab')} + {g('bb')} + {g('hbp')} + {g('sf')})"
    slg = sdiv(f"({g('h')} + {g('x2b')} + 2 * {g('x3b')} + 3 * {g('hr')})", g("ab"))
    obp = sdiv(f"({g('h')} + {g('bb')} + {g('hbp')})", pa)
    b = g("batted_balls")
    return [
        f"{sdiv(g('hr'), pa)} AS hr_per_pa_{w}",
        f"{slg} AS slg_{w}",
        f"{obp} AS obp_{w}",
        f"({slg} + {obp}) AS obs_{w}",
        f"{sdiv(g('ev_sum'), b)} AS ev_{w}",
        f"{sdiv(g('hard_hits'), b)} AS hardhit_{w}",
        f"{sdiv(g('sweet_spots'), b)} AS swspot_{w}",
        f"{sdiv(g('barrels'), b)} AS barrel_{w}",
        f"{sdiv(g('hr_vs_r'), g('ab_vs_r'))} AS hr_per_pa_vs_r_{w}",
        f"{sdiv(g('hr_vs_l'), g('ab_vs_l'))} AS hr_per_pa_vs_l_{w}",
        f"{sdiv(g('est_woba'), b)} AS est_woba_{w}",
        f"{sdiv(g('est_slg'), b)} AS est_slg_{w}",
    ]


def pitcher_rates_sql(w: int) -> list[str]:
    g = lambda c: f"CAST(rollsum_{c}_{w} AS DOUBLE)"
    ip, bf = g("ip"), g("bfp")
    ip_mod = f"(CASE WHEN {ip} IS NOT NULL THEN greatest({ip}, {dbl(float(w * K.IP_PER_GAME_DEF))}) END)"
    bf_mod = f"(CASE WHEN {bf} IS NOT NULL THEN greatest({bf}, {dbl(float(w * K.BF_PER_GAME_DEF))}) END)"
    h, bb, so, er, hr = g("h"), g("bb"), g("so"), g("er"), g("hr")
    tb = f"({h} + ({g('x2b')} + 2.0::DOUBLE * {g('x3b')} + 3.0::DOUBLE * {hr}))"
    h_bb = f"({h} + {bb})"
    fip = f"(13.0::DOUBLE * {hr} + 3.0::DOUBLE * {h_bb} - 2.0::DOUBLE * {so})"
    d_ip, d_bf = f"({ip_mod} - {ip})", f"({bf_mod} - {bf})"
    return [
        f"{sdiv(f'rollsum_hr_{w}', f'rollsum_bfp_{w}')} AS hr_per_bf_{w}",
        f"{sdiv(f'rollsum_fly_balls_{w}', f'rollsum_batted_balls_allowed_{w}')} AS fb_perc_{w}",
        f"(({h_bb} + {dbl(K.H_BB_PER_IP_DEF)} * {d_ip}) / {ip_mod}) AS whip_{w}",
        f"(({so} + {dbl(K.SO_PER_BF_DEF)} * {d_bf}) / {bf_mod}) AS so_perc_{w}",
        f"(({h_bb} + {dbl(K.H_BB_PER_BF_DEF)} * {d_bf}) / {bf_mod}) AS h_bb_perc_{w}",
        f"((({tb} + {bb}) + {dbl(K.TB_BB_PERC_DEF)} * {d_bf}) / {bf_mod}) AS tb_bb_perc_{w}",
        f"((({er} + {dbl(K.ER_PER_IP_DEF)} * {d_ip}) / {ip_mod}) * 9.0::DOUBLE) AS era_{w}",
        f"(({fip} + {dbl(K.FIP_PER_IP_DEF)} * {d_ip}) / {ip_mod}) AS fip_{w}",
        f"(({fip} + {dbl(K.FIP_PER_BF_DEF)} * {d_bf}) / {bf_mod}) AS fip_perc_{w}",
    ]


def collapse_sql(src: str, cols: Sequence[str], keys: Sequence[str], order: str) -> str:
    """Per key, each column's last non-null value in ``order`` (pandas groupby().last())."""
    sel = []
    for c in cols:
        if c in keys:
            sel.append(c)
        elif c == order:
            sel.append(f"max({c}) AS {c}")
        else:
            sel.append(f"arg_max({c}, {order}) FILTER (WHERE {c} IS NOT NULL) AS {c}")
    return f"SELECT {', '.join(sel)} FROM {src} GROUP BY {', '.join(keys)}"
