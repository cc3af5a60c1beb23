"""Fixed values of the domain.

Everything in this module is a fixed value: results depend on these exact
words, codes, orders and numbers, so they are stated as plain text.
"""

# --- fixed values: the 19 model features, by role ---------------------------
ATTACK = ["gls_per90", "ast_per90", "xg_per90", "npxg_per90", "xag_per90", "sot_per90", "sh_per90"]
PASSING = ["prog_passes_per90", "xa_per90", "kp", "pass_completion_pct"]
PROGRESSION = ["prog_carries_per90", "att_3rd_per90", "touches_per90"]
DEFENCE = ["tackles_tkl_per90", "tkl_w_per90", "blocks_per90", "int_per90", "clr_per90"]
MODEL_FEATURES = ATTACK + PASSING + PROGRESSION + DEFENCE

# --- fixed values: counting statistics that get a per-90 rate ---------------
COUNTING_STATS = [
    "gls", "ast", "g+a", "g-pk", "pk", "pkatt",
    "sh", "sot", "touches", "att_3rd", "prog_carries", "prog_passes",
    "tackles_tkl", "tkl_w", "blocks", "int", "clr",
    "xg", "npxg", "xag", "xa",
]
MIN_MINUTES = 450

# --- fixed values: columns averaged per position when a squad row is imputed -
IMPUTED_COLUMNS = [
    "gls_per90", "ast_per90", "xg_per90", "npxg_per90", "xag_per90",
    "sh_per90", "sot_per90", "touches_per90", "prog_carries_per90",
    "prog_passes_per90", "tackles_tkl_per90", "int_per90", "clr_per90",
    "pass_completion_pct", "playing_time_min", "market_value_eur",
]
IMPUTE_SCALE = 0.7
IMPUTE_UNSCALED = "pass_completion_pct"
SQUAD_PREFIXES = ["GK", "DF", "MF", "FW"]

# --- fixed values: broad position groups, first rule that matches wins -------
BROAD_POSITIONS = [
    ("GK", ["GK"]),
    ("DEF", ["CB", "LB", "RB", "WB"]),
    ("MID", ["DM", "CM", "AM", "LM", "RM"]),
    ("FWD", ["LW", "RW", "CF", "ST", "SS", "FW"]),
]
# Second mapping that also knows the plain DF and MF codes.
COARSE_POSITIONS = [
    ("GK", ["GK"]),
    ("DEF", ["CB", "LB", "RB", "WB", "DF"]),
    ("MID", ["DM", "CM", "AM", "LM", "RM", "MF"]),
    ("FWD", ["LW", "RW", "CF", "ST", "SS", "FW"]),
]

# --- fixed values: evaluation groups, last rule that matches wins ------------
EVALUATION_GROUPS = [
    ("GK", ["GK"]),
    ("CB", ["CB"]),
    ("FB", ["LB", "RB", "LWB", "RWB"]),
    ("CDM", ["DM"]),
    ("CM", ["CM"]),
    ("CAM", ["AM"]),
    ("Winger", ["LW", "RW"]),
    ("Striker", ["CF", "ST", "SS", "FW"]),
]

# --- fixed values: radar features and labels --------------------------------
RADAR_FEATURES = [
    "gls_per90", "ast_per90", "xg_per90",
    "prog_carries_per90", "prog_passes_per90",
    "tackles_tkl_per90", "int_per90",
    "pass_completion_pct",
]
FEATURE_LABELS = {
    "gls_per90": "Goals/90",
    "ast_per90": "Assists/90",
    "xg_per90": "xG/90",
    "npxg_per90": "npxG/90",
    "xag_per90": "xAG/90",
    "prog_carries_per90": "Prog. Carries/90",
    "prog_passes_per90": "Prog. Passes/90",
    "tackles_tkl_per90": "Tackles/90",
    "int_per90": "Interceptions/90",
    "clr_per90": "Clearances/90",
    "pass_completion_pct": "Pass Completion %",
    "sh_per90": "Shots/90",
    "sot_per90": "SoT/90",
    "touches_per90": "Touches/90",
}

# --- fixed values: accepted range per column --------------------------------
BOUNDS = {
    "playing_time_min": (450, 4000),
    "age": (15, 45),
    "pass_completion_pct": (0, 100),
    "gls_per90": (0, 5),
}

# --- fixed values: alternate source column names ----------------------------
ALTERNATE_COLUMNS = {
    "short_name": "player",
    "club_name": "squad",
    "league_name": "league",
    "nationality_name": "nation",
    "player_positions": "pos",
    "age": "age",
    "overall": "overall_rating",
    "value_eur": "market_value_eur",
    "wage_eur": "wage_eur",
    "goals_scored": "gls",
    "assists": "ast",
    "minutes_played": "playing_time_min",
    "contract_valid_until": "contract_expires",
}

# --- fixed values: metadata carried over from the market-value table --------
VALUE_METADATA = [
    "market_value_eur", "market_value_raw", "position_detail",
    "age_tm", "contract_expires", "nationality_tm",
]

# --- fixed values: country name to code, raw squad position to code ---------
COUNTRY_CODES = {
    "Czech Republic": "CZE", "Mexico": "MEX", "South Africa": "RSA",
    "South Korea": "KOR", "Bosnia and Herzegovina": "BIH", "Canada": "CAN",
    "Qatar": "QAT", "Switzerland": "SUI", "Brazil": "BRA", "Haiti": "HAI",
    "Morocco": "MAR", "Scotland": "SCO", "Australia": "AUS", "Paraguay": "PAR",
    "Turkey": "TUR", "United States": "USA", "Curaçao": "CUW", "Ecuador": "ECU",
    "Germany": "GER", "Ivory Coast": "CIV", "Japan": "JPN", "Netherlands": "NED",
    "Sweden": "SWE", "Tunisia": "TUN", "Belgium": "BEL", "Egypt": "EGY",
    "Iran": "IRN", "New Zealand": "NZL", "Cape Verde": "CPV", "Saudi Arabia": "SAU",
    "Spain": "ESP", "Uruguay": "URU", "France": "FRA", "Iraq": "IRQ",
    "Norway": "NOR", "Senegal": "SEN", "Algeria": "ALG", "Argentina": "ARG",
    "Austria": "AUT", "Jordan": "JOR", "Colombia": "COL", "DR Congo": "COD",
    "Portugal": "POR", "Uzbekistan": "UZB", "Croatia": "CRO", "England": "ENG",
    "Ghana": "GHA", "Panama": "PAN", "United States of America": "USA",
    "South Korea (Republic of Korea)": "KOR", "Côte d'Ivoire": "CIV",
    "Bosnia-Herzegovina": "BIH",
}
SQUAD_POSITIONS = {
    "1GK": "GK", "GK": "GK", "2DF": "DF", "DF": "DF",
    "3MF": "MF", "MF": "MF", "4FW": "FW", "FW": "FW",
}
SKIPPED_HEADINGS = [
    "Statistics", "Age", "Player representation by club",
    "Player representation by league system",
    "Player representation by club confederation",
    "Average age of squads", "Coach representation by country",
    "Contents", "References", "Notes", "External links", "See also",
]

# --- fixed values: display name per nation code -----------------------------
NATION_LABELS = {
    "ENG": "England", "SCO": "Scotland", "WAL": "Wales", "IRL": "Ireland",
    "ESP": "Spain", "GER": "Germany", "FRA": "France", "ITA": "Italy",
    "POR": "Portugal", "NED": "Netherlands", "BEL": "Belgium", "SUI": "Switzerland",
    "AUT": "Austria", "POL": "Poland", "CZE": "Czech Republic", "SVK": "Slovakia",
    "SVN": "Slovenia", "CRO": "Croatia", "SRB": "Serbia", "DEN": "Denmark",
    "NOR": "Norway", "SWE": "Sweden", "FIN": "Finland", "HUN": "Hungary",
    "UKR": "Ukraine", "TUR": "Turkey", "ARM": "Armenia", "GEO": "Georgia",
    "KOS": "Kosovo", "ISR": "Israel", "ALB": "Albania", "BIH": "Bosnia & Herzegovina",
    "UZB": "Uzbekistan", "QAT": "Qatar", "CPV": "Cape Verde", "RSA": "South Africa",
    "TUN": "Tunisia", "HAI": "Haiti", "CUW": "Curaçao", "PAR": "Paraguay",
    "SAU": "Saudi Arabia", "JOR": "Jordan", "IRQ": "Iraq", "NZL": "New Zealand",
    "CHN": "China", "BRA": "Brazil", "ARG": "Argentina", "COL": "Colombia",
    "URU": "Uruguay", "ECU": "Ecuador", "CHI": "Chile", "BOL": "Bolivia",
    "VEN": "Venezuela", "MEX": "Mexico", "USA": "United States", "CAN": "Canada",
    "CRC": "Costa Rica", "HON": "Honduras", "PAN": "Panama", "JAM": "Jamaica",
    "TRI": "Trinidad & Tobago", "MAR": "Morocco", "NGA": "Nigeria", "SEN": "Senegal",
    "GHA": "Ghana", "CIV": "Ivory Coast", "CMR": "Cameroon", "EGY": "Egypt",
    "ALG": "Algeria", "MLI": "Mali", "GUI": "Guinea", "GAB": "Gabon",
    "COD": "DR Congo", "BFA": "Burkina Faso", "JPN": "Japan", "KOR": "South Korea",
    "IRN": "Iran", "AUS": "Australia",
}

# --- fixed values: flag key per nation code ---------------------------------
FLAG_KEYS = {
    "ENG": "gb-eng", "SCO": "gb-sct", "WAL": "gb-wls", "NIR": "gb-nir",
    "ESP": "es", "GER": "de", "FRA": "fr", "ITA": "it", "IT": "it",
    "POR": "pt", "NED": "nl", "BEL": "be", "SUI": "ch", "CHE": "ch",
    "AUT": "at", "POL": "pl", "CZE": "cz", "SVK": "sk", "SVN": "si",
    "CRO": "hr", "HRV": "hr", "SRB": "rs", "DEN": "dk", "DNK": "dk",
    "NOR": "no", "SWE": "se", "FIN": "fi", "HUN": "hu", "ROU": "ro",
    "RUS": "ru", "UKR": "ua", "GRE": "gr", "GRC": "gr", "TUR": "tr",
    "ARM": "am", "GEO": "ge", "KOS": "xk", "ISR": "il", "AZE": "az",
    "ALB": "al", "BIH": "ba", "MKD": "mk", "MNE": "me",
    "BRA": "br", "ARG": "ar", "COL": "co", "URU": "uy", "CHI": "cl",
    "CHL": "cl", "PER": "pe", "ECU": "ec", "PAR": "py", "BOL": "bo",
    "VEN": "ve", "MEX": "mx", "USA": "us", "CAN": "ca", "CRC": "cr",
    "HON": "hn", "PAN": "pa", "JAM": "jm", "TRI": "tt", "HAI": "ht",
    "MAR": "ma", "NGA": "ng", "SEN": "sn", "GHA": "gh", "CIV": "ci",
    "CMR": "cm", "EGY": "eg", "ALG": "dz", "TUN": "tn", "MLI": "ml",
    "GUI": "gn", "GAB": "ga", "COD": "cd", "BFA": "bf", "CPV": "cv",
    "ZIM": "zw", "ANG": "ao", "MOZ": "mz", "TAN": "tz", "UGA": "ug",
    "KEN": "ke", "ETH": "et", "RSA": "za", "ZAF": "za",
    "JPN": "jp", "KOR": "kr", "CHN": "cn", "IRN": "ir", "SAU": "sa",
    "UAE": "ae", "QAT": "qa", "AUS": "au", "NZL": "nz", "IND": "in",
    "IRQ": "iq", "JOR": "jo", "LBN": "lb", "SYR": "sy",
    "IRL": "ie", "KAZ": "kz", "CUW": "cw", "UZB": "uz",
}
UNKNOWN_FLAG = "un"

# --- fixed values: image address deny lists ---------------------------------
DISPLAY_DENY = [
    "Manchester_City", "Arsenal_", "Chelsea_", "Liverpool_", "Paris_Saint",
    "Bayern_", "Real_Madrid", "Barcelona_", "Dortmund_", "Juventus_",
    "Atletico_", "Inter_", "Milan_", "Leipzig_", "Crystal_Palace",
    "MLS_All_Star", "Wembley", "Yokohama", "_vs_", "Cliff_Blue",
    "Kyle_Daukaus", "Castleton", "FA_Cup_winner", "warm_up_versus",
    "25-26_vs", "2023-07-19", "1_arsenal_crystal",
]
SEARCH_DENY = [".svg", "flag", "logo", "shield", "crest"]
DOWNLOAD_DENY = [
    ".svg", "flag_", "logo_", "_logo", "shield", "crest",
    "coat_of_arms", "emblem", "badge", "jersey", "_kit",
]
IMAGE_EXTENSIONS = ["jpg", "jpeg", "png", "webp", "gif"]
MISSING_INDEX = 999

# --- fixed values: profile sentence -----------------------------------------
PROFILE_SENTENCE = (
    "%s is a %d-year-old %s playing for %s in the %s. "
    "He scores %.2f goals per 90 minutes, records %.2f assists per 90, "
    "completes %.0f%% of passes, generates %.2f xG per 90, "
    "and makes %.2f tackles per 90 minutes."
)
DEFAULT_AGE = 25

# --- fixed values: request vocabulary, in matching order --------------------
REQUEST_POSITIONS = {
    "winger": "FW", "striker": "FW", "forward": "FW", "attacker": "FW",
    "playmaker": "MF", "midfielder": "MF", "midfield": "MF", "mid": "MF",
    "defender": "DF", "defense": "DF", "def": "DF", "center back": "DF",
    "centre back": "DF", "cb": "DF", "fullback": "DF", "full back": "DF",
    "wingback": "DF", "wing back": "DF", "goalkeeper": "GK", "keeper": "GK",
    "gk": "GK",
}
REQUEST_FLAG_PHRASES = ["world cup", "wc", "national team"]
REQUEST_STOP_WORDS = [
    "young", "under", "squad", "club", "league", "winger", "forward", "striker",
    "midfielder", "defender", "keeper", "player", "similar", "like",
]
REQUEST_CUES = [r"like\s+", r"similar\s+to\s+", r"type\s+of\s+", r"replacement\s+for\s+", r"alternative\s+to\s+"]
REQUEST_SKIPPED_GRAMS = ["i want a", "looking for", "under a", "under", "million"]
REQUEST_FILLERS = [
    "i want a", "i want", "want a", "looking for a", "looking for", "find a", "find",
    "player like", "similar to", "like", "type of", "replacement for", "alternative to",
    "under", "less than", "maximum of", "a player", "players", "scout", "search for",
    "winger", "striker", "forward", "attacker", "playmaker", "midfielder", "midfield", "mid",
    "defender", "defense", "def", "center back", "centre back", "cb", "fullback", "full back",
    "wingback", "wing back", "goalkeeper", "keeper", "gk", "world cup", "wc", "national team",
]
DEFAULT_DESCRIPTION = "World Cup 2026 squad player"

# --- fixed values: synthetic profile generator, mean per position -----------
SYNTHETIC_MEANS = {
    "FW": {"gls_per90": 0.42, "ast_per90": 0.17, "xg_per90": 0.40, "npxg_per90": 0.36, "xag_per90": 0.14,
           "sh_per90": 2.8, "sot_per90": 1.1, "touches_per90": 34.0, "prog_carries_per90": 4.3,
           "prog_passes_per90": 2.8, "tackles_tkl_per90": 0.9, "int_per90": 0.5, "clr_per90": 0.25,
           "pass_completion_pct": 74.0},
    "MF": {"gls_per90": 0.16, "ast_per90": 0.24, "xg_per90": 0.13, "npxg_per90": 0.12, "xag_per90": 0.21,
           "sh_per90": 1.4, "sot_per90": 0.45, "touches_per90": 68.0, "prog_carries_per90": 5.2,
           "prog_passes_per90": 7.8, "tackles_tkl_per90": 2.4, "int_per90": 1.4, "clr_per90": 0.6,
           "pass_completion_pct": 87.0},
    "DF": {"gls_per90": 0.04, "ast_per90": 0.06, "xg_per90": 0.04, "npxg_per90": 0.03, "xag_per90": 0.05,
           "sh_per90": 0.45, "sot_per90": 0.12, "touches_per90": 62.0, "prog_carries_per90": 2.4,
           "prog_passes_per90": 6.2, "tackles_tkl_per90": 3.3, "int_per90": 1.9, "clr_per90": 4.8,
           "pass_completion_pct": 84.0},
    "GK": {"gls_per90": 0.0, "ast_per90": 0.01, "xg_per90": 0.0, "npxg_per90": 0.0, "xag_per90": 0.01,
           "sh_per90": 0.05, "sot_per90": 0.0, "touches_per90": 38.0, "prog_carries_per90": 0.3,
           "prog_passes_per90": 3.2, "tackles_tkl_per90": 0.1, "int_per90": 0.05, "clr_per90": 1.2,
           "pass_completion_pct": 62.0},
}
SYNTHETIC_SPREAD = {
    "gls_per90": 0.12, "ast_per90": 0.08, "xg_per90": 0.10, "npxg_per90": 0.09, "xag_per90": 0.07,
    "sh_per90": 0.5, "sot_per90": 0.28, "touches_per90": 8.0, "prog_carries_per90": 0.8,
    "prog_passes_per90": 1.2, "tackles_tkl_per90": 0.5, "int_per90": 0.3, "clr_per90": 0.8,
    "pass_completion_pct": 5.0,
}
SYNTHETIC_BASE_VALUE = {"FW": 18e6, "MF": 14e6, "DF": 11e6, "GK": 7e6}
ELITE_FACTOR = 1.3
FLAGGED_NATIONS = [
    "ARG", "BRA", "FRA", "ENG", "ESP", "GER", "POR", "NED", "MAR", "SEN", "NGA", "JPN",
    "USA", "MEX", "COL", "URU", "KOR", "EGY", "CAN", "SUI", "CRO", "BEL", "DEN", "AUS",
    "CIV", "POL", "TUR", "SRB", "GEO", "ECU", "AUT", "SCO", "NOR", "IRN", "ITA", "UKR",
    "SWE", "HUN", "GHA", "CMR", "ALG", "WAL", "SVK", "SVN", "CZE", "ROU", "TUN", "KSA",
    "CRC", "PER", "CHI", "RSA", "COD", "GUI", "BFA", "GAB", "MLI", "JAM", "IRL", "FIN",
]

# --- fixed values: request patterns, in matching order ----------------------
MILLION_PATTERNS = [
    r"(?:under|below|less\s+than|max|maximum|budget|price|value|cost|limit|cap|of|to)\s*[\$€£]?\s*(\d+(?:\.\d+)?)\s*(?:m|million|M)\b",
    r"[\$€£]\s*(\d+(?:\.\d+)?)\s*(?:m|million|M)\b",
]
FULL_NUMBER_PATTERN = r"(?:under|below|less\s+than|max|maximum|budget)\s*[\$€£]?\s*(\d{1,3}(?:,\d{3})+|\d{6,10})\b"
ANY_MILLION_PATTERN = r"\b(\d+(?:\.\d+)?)\s*(?:m|million|M)\b"
MONEY_TEXT_PATTERNS = [
    r"(?:under|below|less\s+than|max|maximum|budget|price|value|cost|limit|cap|of|to)?\s*[\$€£]?\s*\d+(?:\.\d+)?\s*(?:m|million|M)\b",
    r"[\$€£]\s*\d+(?:\.\d+)?\s*(?:m|million|M)\b",
    r"(?:under|below|less\s+than|max|maximum|budget)\s*[\$€£]?\s*(?:\d{1,3}(?:,\d{3})+|\d{6,10})\b",
]
REQUEST_NAME_LETTERS = r"[a-zA-Z\s'\-ÆæØøÅåÉéÈèÜüÄäÖöíáóúñ]+"
