"""Fixed values.

Code lists, labels, rates and edges below are business data that results must
carry exactly; they are stated as they are and nothing is derived from them here.
"""

# --- price code, first character -> place labels -----------------------------
LOCATION_GENERAL = {
    "General": list("ABCDEFGHIJKLMNOPQRST12345678"),
    "Suites": list("UVW"),
    "Amerant Vault": ["X"],
    "Loft": ["Y"],
    "Corona": ["Z"],
    "Parking": ["9"],
}
LOCATION_SPECIFIC = {
    "Lowers": list("ABCDEFGHIJ12345678"),
    "Clubs": list("KLM"),
    "Uppers": list("NOPQRST"),
    "Suites": list("UVW"),
    "Lounge 954": ["X"],
    "Loft": ["Y"],
    "Corona": ["Z"],
}
LOCATION_EVENTS = {
    "ENN's": list("ABCDEFGHIJ12345678KLMNOPQRST"),
    "Loge Box": ["U"],
    "Club Suites": ["V"],
    "Suites": ["W"],
    "Lounge 954": ["X"],
    "Loft": ["Y"],
    "Corona": ["Z"],
}
LOCATION_EVENTS_GENERAL = {
    "ENN's": list("ABCDEFGHIJ12345678KLMNOPQRST"),
    "Suites": list("UVW"),
    "Clubs": list("XYZ"),
}
ARENA_LEVEL = {
    "Lowers": list("ABCDEFGHIJKLM12345678"),
    "Clubs": list("XZ"),
    "Uppers": list("NOPQRSTY"),
    "Suites": list("UVW"),
}
ARENA_LEVEL_INTERNAL = {
    "Lowers": list("ABCDEFGHIJ12345678"),
    "Clubs": list("KLM"),
    "Uppers": list("NOPQRSTY"),
    "Suites": list("UVW"),
    "Premium": list("XZ"),
}
PREMIUM_CODES = list("UVWXZ12")

# --- price code, second character -> plan -------------------------------------
PLAN_TYPE = {
    "Full": ["F"],
    "Half": ["A", "B", "H"],
    "Premier": ["P"],
    "Singles": ["I", "*", ""],
    "Flex": ["X"],
    "Groups": ["G"],
}

# --- accounts -------------------------------------------------------------------
CORPORATE_WORDS = [
    "Sponsor", "Business", "Broker", "Community", "Suite", "Marketing", "PR", "Trade", "Box Office",
]
ACCOUNT_TRADE_LABELS = {
    "Sponsor": ["Sponsor"],
    "Sponsor Trade": ["Sponsor Trade", "Trade-Sponsor"],
    "Marketing Trade": ["Marketing Trade", "Trade-Marketing"],
    "Trade": ["Trade"],
}

# --- money ------------------------------------------------------------------------
TAX_DIVISOR = 1.07
FOOD_FEE = {"Z": 25, "Y": 15, "X": 35}
FOOD_FEE_EVENTS = {"Z": 25, "X": 35}
RESALE_SHARE = 0.93
PARKING_REFUND_PER_SEAT = 5
PARKING_REFUND_TYPES = ["J-TYPE", "L-TYPE"]
GAMES_PER_SEASON = 42
PREMIER_GAMES = 25
HALF_GAMES = 20
GATE_PRICE_DIVISOR = 0.75

# --- sales calendar ------------------------------------------------------------
SALES_START = {
    "2018-19": "2018-02-05",
    "2019-20": "2019-02-11",
    "2020-21": "2020-02-05",
    "2021-22": "2021-03-01",
    "2022-23": "2022-02-03",
    "2023-24": "2023-02-07",
    "2024-25": "2024-01-10",
}
DAYS_OUT_BUCKETS = [
    (None, 0, "A: Day Of"),
    (1, 3, "B: 1-3 Days Out"),
    (4, 7, "C: 4-7 Days Out"),
    (8, 14, "D: 1-2 Weeks Out"),
    (15, 30, "E: 2-4 Weeks Out"),
    (31, 60, "F: 1-2 Months Out"),
    (61, 90, "G: 2-3 Months Out"),
    (91, None, "H: 3+ Months Out"),
]
DOUBLE_COMMISSION_ADDED = ("2022-10-03", "2022-10-14")
DOUBLE_COMMISSION_EVENTS = ["22H1006E", "22H1019C", "22H1023D"]

# --- number codes ------------------------------------------------------------------
LEVEL_NUMBER = {"Clubs": 5, "Lowers": 4, "Uppers": 3, "Suites": 2, "Premium": 1}
TIER_NUMBER = {"A": 5, "B": 4, "C": 3, "D": 2, "E": 1}
START_TIME_NUMBER = {
    1: ["12:30 PM", "12:45 PM", "1:00 PM", "3:00 PM", "3:30 PM"],
    2: ["4:00 PM", "5:00 PM", "6:00 PM"],
}
SURVEY_LIKELIHOOD = {
    "Definitely": 3, "Most likely": 2, "Neutral": 1, "Unlikely": -1, "Definitely not": -2,
}
LEVEL_ORDER = {"Premium": 1, "Lowers": 2, "Clubs": 3, "Uppers": 4}

# --- bins ---------------------------------------------------------------------------
TOUCHPOINT_EDGES = [0, 3, 7, 15]
SPEND_EDGES = {"Premier": [0, 2500, 5000, 10000, 20000], "Full": [0, 5000, 10000, 20000, 40000]}
SCORE_EDGES = ([0, 0.5, 0.75, 0.9, 1], ["Tier 4", "Tier 3", "Tier 2", "Tier 1"])
ATTENDANCE_EDGES = ([0, 1, 6, 11, None], ["Tier 4", "Tier 3", "Tier 2", "Tier 1"])
EMAIL_EDGES = ([0, 1, 51, 101, 201, None], ["Tier 5", "Tier 4", "Tier 3", "Tier 2", "Tier 1"])
#: By feature; all others weigh 1.
FEATURE_WEIGHTS = {
    "Full": {"paid_show_rate": 2, "show_rate": 2, "renewal_likelihood_survey": 2},
    "Premier": {"paid_show_rate": 1.5, "show_rate": 1.5, "renewal_likelihood_survey": 2},
}

# --- budget ------------------------------------------------------------------------------
GAMES_PER_TIER = {"A": 2, "B": 6, "C": 14, "D": 10, "E": 9}
REVENUE_SHARE_PER_TIER = {"A": 0.07, "B": 0.16, "C": 0.3, "D": 0.25, "E": 0.22}
REVENUE_SHARE_PER_LEVEL = {
    "Suites": 0.1821, "Clubs": 0.0851, "Uppers": 0.0571, "Premium": 0.2509, "Lowers": 0.4247,
}
GROUP_GROWTH = 0.362147
GROUP_GAMES = 41
PARKING_AVERAGE_PRICE = 42.8
FOOD_BASE_PER_CAP = 26.84
MERCH_BASE_PER_CAP = 11.91
RESALE_ATP_FACTOR = 0.85
VENUE_CAPACITY = 19500

# --- priority of a seat or suite status, strongest first -----------------------------
STATUS_ORDER = ["COMP", "SOLD", "HELD", "AVAIL"]

# --- television market -> counties ----------------------------------------------------
MARKET_COUNTIES = {
    "mia_ftl": ["Broward", "Miami-Dade", "Monroe", None, None],
    "pb": ["Palm Beach", "Okeechobee", "Indian River", "St Lucie", "Martin"],
    "fm": ["Lee", "Charlotte", "Collier", None, None],
}
