"""Fixed values shared by the whole library.

Everything in this file is data, not logic.  The tables are small constants, so
they are used as literal maps inside expressions: no join, no shuffle.
"""

# --- fixed values: calendar, courses, strokes -------------------------------
MONTHS = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]
COURSES = ["SCY", "SCM", "LCM"]
STROKE_NAMES = {
    "Free": "Freestyle",
    "Back": "Backstroke",
    "Breast": "Breaststroke",
    "Fly": "Butterfly",
    "IM": "IM",
}
STROKE_TOKENS = {
    "free": "Free",
    "back": "Back",
    "breast": "Breast",
    "fly": "Fly",
    "im": "IM",
    "medley": "IM",
}

# --- fixed values: structural vocabulary (21 events x 3 courses x 9 ages) ----
STRUCTURAL_DISTANCES = {
    "Free": [50, 100, 200, 400, 500, 800, 1000, 1500, 1650],
    "Back": [50, 100, 200],
    "Breast": [50, 100, 200],
    "Fly": [50, 100, 200],
    "IM": [100, 200, 400],
}
YOUTH_AGES = (10, 18)
ADULT_AGES = (20, 49)
STRUCTURAL_EVENTS = [f"{d}m{s}" for s, ds in STRUCTURAL_DISTANCES.items() for d in ds]

# --- fixed values: games programme ------------------------------------------
PROGRAMME_EVENTS = [
    "50m Freestyle", "100m Freestyle", "200m Freestyle", "400m Freestyle",
    "800m Freestyle", "1500m Freestyle",
    "100m Backstroke", "200m Backstroke",
    "100m Breaststroke", "200m Breaststroke",
    "100m Butterfly", "200m Butterfly",
    "200m IM", "400m IM",
    "4x100m Freestyle Relay", "4x200m Freestyle Relay", "4x100m Medley Relay",
    "4x100m Mixed Medley Relay",
]
NON_INDIVIDUAL_WORDS = ["relay", "4x", "marathon", "open water", "10k"]

# --- fixed values: events that can become a label ----------------------------
LABEL_DISTANCES = {
    "Free": [50, 100, 200, 400, 800, 1500],
    "Back": [50, 100, 200],
    "Breast": [50, 100, 200],
    "Fly": [50, 100, 200],
    "IM": [100, 200, 400],
}
LABEL_BY_EVENT = {
    f"{d}m{s}": f"{d}m_{STROKE_NAMES[s]}" for s, ds in LABEL_DISTANCES.items() for d in ds
}
NO_EVENT_LABEL = "No_Olympic_Event"

# --- fixed values: pass thresholds in seconds, ages 10 to 18 -----------------
THRESHOLDS = {
    "50m_Freestyle": [32.0, 31.0, 30.0, 29.0, 28.0, 27.0, 26.0, 25.0, 24.0],
    "100m_Freestyle": [70.0, 68.0, 66.0, 64.0, 62.0, 60.0, 58.0, 56.0, 54.0],
    "200m_Freestyle": [150.0, 145.0, 140.0, 135.0, 130.0, 125.0, 120.0, 115.0, 110.0],
    "100m_Backstroke": [75.0, 73.0, 71.0, 69.0, 67.0, 65.0, 63.0, 61.0, 59.0],
    "100m_Breaststroke": [80.0, 78.0, 76.0, 74.0, 72.0, 70.0, 68.0, 66.0, 64.0],
    "100m_Butterfly": [75.0, 73.0, 71.0, 69.0, 67.0, 65.0, 63.0, 61.0, 59.0],
    "200m_IM": [160.0, 155.0, 150.0, 145.0, 140.0, 135.0, 130.0, 125.0, 120.0],
}
OPEN_THRESHOLD = 999.0

# --- fixed values: age factors, ages 10 to 18, and baselines in seconds ------
PROGRESSION_FACTORS = [1.40, 1.35, 1.30, 1.25, 1.20, 1.15, 1.10, 1.05, 1.00]
PROGRESSION_DEFAULT = 1.25
BASELINE_FACTORS = [1.35, 1.30, 1.25, 1.20, 1.15, 1.10, 1.05, 1.02, 1.00]
BASELINE_FACTOR_DEFAULT = 1.20
BASELINE_SECONDS = {
    "50mFree": 22.5, "50mBack": 25.0, "50mBreast": 28.0, "50mFly": 24.0,
    "100mFree": 48.0, "100mBack": 52.0, "100mBreast": 58.0, "100mFly": 51.0, "100mIM": 55.0,
    "200mFree": 105.0, "200mBack": 110.0, "200mBreast": 125.0, "200mFly": 112.0, "200mIM": 118.0,
    "400mFree": 220.0, "400mIM": 240.0,
    "800mFree": 460.0,
    "1000mFree": 580.0,
    "1500mFree": 870.0,
    "1650mFree": 900.0,
}
BASELINE_BY_DISTANCE = {
    50: 25.0, 100: 55.0, 200: 120.0, 400: 250.0, 800: 500.0, 1000: 620.0, 1500: 900.0, 1650: 900.0,
}
BASELINE_DEFAULT = 60.0

# --- fixed values: athlete records -------------------------------------------
REQUIRED_ATHLETE_FIELDS = ["name", "dob", "height_cm", "weight_kg", "gender", "race", "paris_2024_races"]
SEX_CODES = {"male": 0, "m": 0, "female": 1, "f": 1}
GROUP_LABELS = ["white", "black", "asian", "hispanic", "pacific islander", "native american"]
ATHLETE_ALIASES = {
    "Name": ["Name", "Swimmer_ID", "name"],
    "Date_of_Birth": ["Date_of_Birth", "dob"],
    "Sex": ["Sex", "gender"],
    "Height_cm": ["Height_cm", "height_cm"],
    "Weight_kg": ["Weight_kg", "weight_kg"],
    "Ethnicity": ["Ethnicity", "race"],
}
COUNTRY_SUFFIXES = [
    "United States", "France", "Germany", "Australia", "Canada", "Great Britain",
    "Italy", "Japan", "China", "Brazil", "Netherlands", "Sweden", "Hungary",
    "Romania", "Poland", "Spain", "South Africa", "New Zealand",
]
NON_PERSON_MARKS = ["relay", "team", "&", " and ", ","]

# --- fixed values: stored pages ----------------------------------------------
BLOCK_PHRASES = ["403 Forbidden", "Access Denied"]
GAMES_PHRASE = "olympic games"
GAMES_DATE_PHRASES = ["2024", "jul 27", "july 27", "aug 4", "august 4"]
GAMES_RESULT_PATH = "/results/2424"
CELL_STROKE_WORDS = ["free", "back", "breast", "fly", "medley"]
CELL_COURSES = ["LCM", "SCM", "SCY", "LCY"]
SESSIONS = ["finals", "semifinals", "preliminaries"]
SESSION_SHORT = {"prelims": "preliminaries"}

# --- fixed values: scoring ----------------------------------------------------
MISSING_TIME_DEFAULT = 999.0
MISSING_OTHER_DEFAULT = 0.0
ADVICE = {
    "Freestyle": "Focus on freestyle technique and endurance training",
    "Backstroke": "Work on backstroke technique and core strength",
    "Breaststroke": "Develop breaststroke timing and leg strength",
    "Butterfly": "Build butterfly power and shoulder strength",
    "IM": "Train all four strokes and build endurance",
}
SCORING_DISTANCES = {
    "Free": [50, 100, 200, 400, 800, 1500],
    "Back": [50, 100, 200],
    "Breast": [50, 100, 200],
    "Fly": [50, 100, 200],
    "IM": [100, 200, 400],
}
SCORING_EVENTS = [f"{d}m{s}" for s, ds in SCORING_DISTANCES.items() for d in ds]

# --- fixed values: hyper-parameter search space -------------------------------
SEARCH_SPACE = {
    "numTrees": [100, 200, 300, 400, 500],
    "maxDepth": [5, 10, 20, 30],
    "minInstancesPerNode": [1, 2, 4, 6],
    "featureSubsetStrategy": ["sqrt", "log2", "all"],
    "weighted": [True, False],
    "bootstrap": [True, False],
}
SEARCH_DRAWS = 50
SEARCH_FOLDS = 5
TEST_FRACTION = 0.2
SEED = 42
# Part of the address of a person's page.
PERSON_PATH = "/swimmer/"
