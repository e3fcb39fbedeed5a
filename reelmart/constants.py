"""Fixed values that results depend on.

FIXED VALUES: every label, list and threshold below must stay exactly as
written, because query results and data-quality checks are compared
against them. They are listed in the order the rules evaluate them.
"""

from decimal import Decimal

# --- FIXED VALUES: source catalogue -------------------------------------------------

# Landing file name -> raw table name, and the raw column order of each file.
SOURCE_FILES = {
    "title.basics.tsv": "title_basics",
    "title.ratings.tsv": "title_ratings",
    "title.akas.tsv": "title_akas",
    "title.principals.tsv": "title_principals",
    "name.basics.tsv": "name_basics",
}

RAW_COLUMNS = {
    "title_akas": ["titleid", "ordering", "title", "region", "language", "types",
                   "attributes", "isoriginaltitle"],
    "title_basics": ["tconst", "titletype", "primarytitle", "originaltitle", "isadult",
                     "startyear", "endyear", "runtimeminutes", "genres"],
    "title_principals": ["tconst", "ordering", "nconst", "category", "job", "characters"],
    "title_ratings": ["tconst", "averagerating", "numvotes"],
    "name_basics": ["nconst", "primaryname", "birthyear", "deathyear", "primaryprofession",
                    "knownfortitles"],
}

# Primary keys declared on the raw tables (not null + unique).
RAW_KEYS = {
    "title_basics": "tconst",
    "title_ratings": "tconst",
    "name_basics": "nconst",
}

# COPY text dialect: field separator and the NULL marker.
FIELD_SEPARATOR = "\t"
NULL_MARKER = "\\N"

# --- FIXED VALUES: staging ----------------------------------------------------------

SUPPORTED_TITLE_TYPES = [
    "movie", "short", "tvEpisode", "tvMiniSeries", "tvMovie",
    "tvSeries", "tvShort", "tvSpecial", "video", "videoGame",
]

# --- FIXED VALUES: dim_titles -------------------------------------------------------

ADULT_CONTENT = "Adult Content"
GENERAL_AUDIENCE = "General Audience"

RUNTIME_UNKNOWN = "Unknown"
RUNTIME_SHORT = "Short (≤30 min)"          # runtime <= 30
RUNTIME_STANDARD = "Standard (31-90 min)"  # runtime <= 90
RUNTIME_LONG = "Long (91-180 min)"         # runtime <= 180
RUNTIME_EXTENDED = "Extended (>180 min)"   # otherwise

# title_type groups -> content_category, in evaluation order; otherwise 'Other'.
CONTENT_CATEGORIES = [
    (["movie", "tvMovie"], "Movie"),
    (["tvSeries", "tvMiniSeries"], "TV Series"),
    (["tvEpisode"], "TV Episode"),
    (["short", "tvShort"], "Short Film"),
    (["tvSpecial"], "TV Special"),
    (["video"], "Video"),
    (["videoGame"], "Video Game"),
]
CONTENT_OTHER = "Other"

SERIES_TYPES = ["tvSeries", "tvMiniSeries"]
RECENT_YEARS = 5

TITLE_SHORT = "Short Title"    # length <= 20
TITLE_MEDIUM = "Medium Title"  # length <= 50
TITLE_LONG = "Long Title"      # otherwise (and NULL)

# --- FIXED VALUES: dim_people -------------------------------------------------------

AGE_UNKNOWN = "Unknown"
AGE_LADDER = [  # (age strictly below, label); otherwise 'Elder (70+)'
    (30, "Young (Under 30)"),
    (50, "Mid-Career (30-49)"),
    (70, "Veteran (50-69)"),
]
AGE_ELDER = "Elder (70+)"

# Case-blind substring patterns for the role flags.
ROLE_PATTERNS = {
    "is_actor": ["actor", "actress"],
    "is_director": ["director"],
    "is_writer": ["writer"],
    "is_producer": ["producer"],
    "is_composer": ["composer"],
}

GENERATION_UNKNOWN = "Unknown Generation"
GENERATIONS = [  # (first birth year, last birth year, label), inclusive ranges
    (1928, 1945, "Silent Generation"),
    (1946, 1964, "Baby Boomers"),
    (1965, 1980, "Generation X"),
    (1981, 1996, "Millennials"),
    (1997, 2012, "Generation Z"),
]
GENERATION_ALPHA_AFTER = 2012
GENERATION_ALPHA = "Generation Alpha"
GENERATION_PRE_SILENT = "Pre-Silent Generation"

# --- FIXED VALUES: fact_ratings -----------------------------------------------------

RATING_NOT_RATED = "Not Rated"
RATING_LADDER = [  # (rating strictly below, label); otherwise 'Outstanding (9.0+)'
    (Decimal("3.0"), "Poor (< 3.0)"),
    (Decimal("5.0"), "Below Average (3.0-4.9)"),
    (Decimal("7.0"), "Average (5.0-6.9)"),
    (Decimal("8.0"), "Good (7.0-7.9)"),
    (Decimal("9.0"), "Excellent (8.0-8.9)"),
]
RATING_OUTSTANDING = "Outstanding (9.0+)"

VOTES_NONE = "No Votes"
VOTE_LADDER = [  # (votes strictly below, label); otherwise 'Massive (1M+)'
    (100, "Minimal (< 100)"),
    (1000, "Low (100-999)"),
    (10000, "Moderate (1K-9K)"),
    (100000, "High (10K-99K)"),
    (1000000, "Very High (100K-999K)"),
]
VOTES_MASSIVE = "Massive (1M+)"

SIGNIFICANT_VOTES = 1000
HIGHLY_RATED = (Decimal("8.0"), 10000)       # rating >=, votes >=
MAINSTREAM_SUCCESS = (Decimal("7.0"), 100000)

CONFIDENCE_NONE = "No Confidence"
CONFIDENCE_LADDER = [  # (votes strictly below, label); otherwise 'Very High Confidence'
    (10, "Very Low Confidence"),
    (100, "Low Confidence"),
    (1000, "Medium Confidence"),
    (10000, "High Confidence"),
]
CONFIDENCE_TOP = "Very High Confidence"

PERCENTILE_TIERS = [  # (rating at least, label); otherwise 'Bottom 50%'
    (Decimal("8.5"), "Top 1%"),
    (Decimal("8.0"), "Top 5%"),
    (Decimal("7.5"), "Top 10%"),
    (Decimal("7.0"), "Top 25%"),
    (Decimal("6.0"), "Top 50%"),
]
PERCENTILE_BOTTOM = "Bottom 50%"

CRITICAL_ACCLAIM = "Critical Acclaim"              # rating >= 8.0
POPULAR_SUCCESS = "Popular Success"                # rating >= 7.0 and votes >= 50000
COMMERCIAL_SUCCESS = "Commercial Success"          # rating >= 6.0 and votes >= 10000
CRITICAL_FAILURE = "Critical Failure"              # rating < 4.0 and votes >= 5000
HIGH_VISIBILITY = "High Visibility"                # votes >= 100000
STANDARD_RELEASE = "Standard Release"              # otherwise

QUADRANT_SPLIT = (Decimal("7.0"), 10000)  # rating, votes
QUADRANT_HH = "High Quality, High Popularity"
QUADRANT_HL = "High Quality, Low Popularity"
QUADRANT_LH = "Low Quality, High Popularity"
QUADRANT_LL = "Low Quality, Low Popularity"
QUADRANTS = [QUADRANT_HH, QUADRANT_HL, QUADRANT_LH, QUADRANT_LL]

# --- FIXED VALUES: bridge_cast_crew -------------------------------------------------

ROLE_DEPARTMENTS = [  # job categories -> department, in evaluation order; otherwise 'Other'
    (["actor", "actress"], "Acting"),
    (["director"], "Directing"),
    (["writer"], "Writing"),
    (["producer", "executive producer"], "Producing"),
    (["composer", "music_department"], "Music"),
    (["cinematographer", "camera_department"], "Cinematography"),
    (["editor"], "Editing"),
]
DEPARTMENT_OTHER = "Other"
ACTING_CATEGORIES = ["actor", "actress"]

CREDIT_UNSPECIFIED = "Unspecified"
CREDIT_LADDER = [  # (ordering at most, label); otherwise 'Background'
    (3, "Lead/Principal"),
    (10, "Supporting"),
    (50, "Featured"),
]
CREDIT_BACKGROUND = "Background"

MEDIA_TYPES = [  # content_category -> media_type; otherwise content_category itself
    ("Movie", "Film"),
    ("TV Series", "Television"),
    ("TV Episode", "Episode"),
]

ERA_UNKNOWN = "Unknown Era"
ERA_LADDER = [  # (start year strictly below, label); otherwise 'Streaming Era (2010+)'
    (1950, "Golden Age (Pre-1950)"),
    (1970, "Classic Era (1950-1969)"),
    (1990, "Modern Era (1970-1989)"),
    (2010, "Digital Era (1990-2009)"),
]
ERA_STREAMING = "Streaming Era (2010+)"

# --- FIXED VALUES: analytics --------------------------------------------------------

RECENT_LABEL = "Recent (2020+)"
CLASSIC_LABEL = "Classic (Pre-2020)"

CHART_RUNTIME_GROUPS = [  # (runtime at most, label); otherwise 'Long (over 180 min)'
    (90, "Short (90 min or less)"),
    (180, "Medium (91-180 min)"),
]
CHART_RUNTIME_LONG = "Long (over 180 min)"

CHART_PRIMARY_ROLES = [  # first matching flag wins; otherwise 'Other'
    ("is_actor", "Actor"),
    ("is_director", "Director"),
    ("is_writer", "Writer"),
    ("is_producer", "Producer"),
]
CHART_ROLE_OTHER = "Other"

AVERAGE_QUALITY = "Average Quality"
