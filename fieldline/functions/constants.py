"""Fixed values.

These must equal the values of the feature definitions being reproduced, or results differ.
They are stated plainly, in natural order, in one place.
"""

# --- fixed values: plate-appearance outcome lists -------------------------------------------
NON_AB_EVENTS = [
    "walk",
    "intent_walk",
    "hit_by_pitch",
    "sac_bunt",
    "sac_fly",
    "sac_fly_error",
    "catcher_interf",
]
HIT_EVENTS = ["single", "double", "triple", "home_run"]
WALK_EVENTS = ["walk", "intent_walk"]

# --- fixed values: outs recorded per terminal event (everything else records 0) -------------
OUTS_BY_EVENT = {
    "strikeout": 1,
    "field_out": 1,
    "force_out": 1,
    "sac_bunt": 1,
    "sac_fly": 1,
    "fielders_choice_out": 1,
    "grounded_into_double_play": 2,
    "double_play": 2,
    "triple_play": 3,
}

# --- fixed values: window lengths (rows = games) ---------------------------------------------
BATTER_WINDOWS = [7, 14, 30, 75, 162, 350]
PITCHER_WINDOWS = [10, 35, 75]
TEAM_WINDOWS = [162, 90, 30]

# --- fixed values: rolled-up columns summed by the rolling feature builders -----------------
BATTER_SUM_COLUMNS = [
    "hr", "ab", "bb", "h", "hbp", "sf", "x2b", "x3b", "hr_vs_r", "ab_vs_r", "hr_vs_l",
    "ab_vs_l", "barrels", "ev_sum", "hard_hits", "sweet_spots", "batted_balls", "est_woba",
    "est_slg",
]
PITCHER_SUM_COLUMNS = [
    "hr", "bfp", "fly_balls", "batted_balls_allowed", "ip", "h", "bb", "so", "er", "x2b", "x3b",
]
TEAM_SUM_COLUMNS = ["AB", "H", "x2B", "x3B", "HR", "BB", "runs", "SB", "CS", "ERR"]

# --- fixed values: league-average padding for smoothed pitcher rates -----------------------
IP_PER_GAME_DEF = 3
BF_PER_GAME_DEF = 12
H_BB_PER_IP_DEF = 1.5
H_BB_PER_BF_DEF = 0.37
SO_PER_BF_DEF = 0.2
TB_BB_PERC_DEF = 0.45
ER_PER_IP_DEF = 5 / 9
FIP_PER_IP_DEF = 0.124 * 13 + 1.5 * 3 - 2 * 0.8
FIP_PER_BF_DEF = 0.03 * 13 + 0.37 * 3 - 2 * 0.2

# --- fixed values: batted-ball thresholds ---------------------------------------------------
HARD_HIT_MIN_SPEED = 95
SWEET_SPOT_MIN_ANGLE = 8
SWEET_SPOT_MAX_ANGLE = 32
BARREL_CODE = 6

# --- fixed values: team lists --------------------------------------------------------------
# Odds-site team numbers: 26995 + position in this list.
ODDS_SITE_FIRST_NUMBER = 26995
ODDS_SITE_TEAMS = [
    "PHI", "SDN", "SFN", "ANA", "DET", "CIN", "NYA", "TEX", "TBA", "COL",
    "MIN", "KCA", "ARI", "BAL", "ATL", "TOR", "SEA", "MIL", "PIT", "NYN",
    "LAN", "OAK", "WAS", "CHA", "SLN", "CHN", "BOS", "MIA", "HOU", "CLE",
]
ODDS_FIRST_LOOKUP_SEASON = 2022

# --- fixed values: defaults of the jobs ----------------------------------------------------
ROLLING_LOOKBACK_DAYS = 365
RECENT_RELIEVER_DAYS = 7
MIN_BATTER_PA = 50
MIN_PITCHER_GS = 5
SEASON_CALENDAR = ((3, 20), (11, 5))  # (month, day) first and last day, results backfill
WEEKLY_CHUNK_SEASON = ((3, 20), (10, 15))  # pitch backfill
PLAYER_FETCH_RANGE = ((3, 1), (11, 30))
NAN_STRINGS = ["nan", "NaN", "NAN"]
REQUIRED_PITCH_COLUMNS = ["GAME_PK", "GAME_DATE", "PITCHER", "BATTER", "AT_BAT_NUMBER", "PITCH_NUMBER"]
