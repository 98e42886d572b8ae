"""Fixed values that must equal the original job's for identical results.

FIXED VALUES — the cleaning and matching rules below are behaviour, not
design: patterns, replacement texts, word lists, band lists and time formats
are listed plainly, in the order they are applied.  Patterns are written in
the common regex subset of Java (Spark) and RE2 (DuckDB oracle); the engines
add their own case / Unicode flags.
"""

# ---------------------------------------------------------------- FIXED VALUES
# Artist cleaning, applied in this order after stripping quotes and
# collapsing whitespace.  All case-insensitive.
ARTIST_RULES = [
    (r"\s*\(.*?\)\s*", ""),
    (r"\s*\[.*?\]\s*", ""),
    (r"\s*\{.*?\}\s*", ""),
    (r"\s+FEAT\.?\s+", " FEAT. "),
    (r"\s+FEATURING\s+", " FEAT. "),
    (r"\s+FT\.?\s+", " FEAT. "),
    (r"\s+W/\s+", " FEAT. "),
    (r"\s+WITH\s+", " FEAT. "),
    (r"\bFEAT\s+", "FEAT. "),
    (r"\bFEATURING\s+", "FEAT. "),
    (r"[\x{2013}\x{2014}]", "-"),
    (r"\.{2,}", "."),
    (r"^[.\-\s]+", ""),
    (r"[.\-\s]+$", ""),
    (r"\s*\.\s*", ". "),
    (r"\s*,\s*", ", "),
    (r"\s*;\s*", "; "),
    (r"\s*:\s*", ": "),
    (r"\s*!\s*", "! "),
    (r"\s*\?\s*", "? "),
    (r"\s+", " "),
]

# Song cleaning, applied in this order (the suffix rules repeat on purpose:
# each pass removes one more trailing annotation of that kind).
SONG_RULES = [
    (r"\s*\(live\)\s*$", ""),
    (r"\s*\(Live\)\s*$", ""),
    (r"\s*\(LIVE\)\s*$", ""),
    (r"\s*\(acoustic\)\s*$", ""),
    (r"\s*\(Acoustic\)\s*$", ""),
    (r"\s*\(ACOUSTIC\)\s*$", ""),
    (r"\s*\(radio edit\)\s*$", ""),
    (r"\s*\(Radio Edit\)\s*$", ""),
    (r"\s*\(clean\)\s*$", ""),
    (r"\s*\(Clean\)\s*$", ""),
    (r"\s*\(explicit\)\s*$", ""),
    (r"\s*\(Explicit\)\s*$", ""),
    (r"\s*\(remix\)\s*$", ""),
    (r"\s*\(Remix\)\s*$", ""),
    (r"\s*\(REMIX\)\s*$", ""),
    (r"\s+FEAT\.?\s+", " FEAT. "),
    (r"\s+FEATURING\s+", " FEAT. "),
    (r"\s+FT\.?\s+", " FEAT. "),
    (r"\s+W/\s+", " FEAT. "),
    (r"\s+WITH\s+", " FEAT. "),
    (r"\bFEAT\s+", "FEAT. "),
    (r"\bFEATURING\s+", "FEAT. "),
    (r"[\x{2013}\x{2014}]", "-"),
    (r"\.{2,}", "."),
    (r"\s*\.\s*", ". "),
    (r"\s*,\s*", ", "),
    (r"\s*;\s*", "; "),
    (r"\s*:\s*", ": "),
    (r"\s*!\s*", "! "),
    (r"\s*\?\s*", "? "),
    (r"\s+", " "),
    (r"^[.\-\s]+", ""),
    (r"[.\-\s]+$", ""),
]

# Whole-word fixes after title casing (case-insensitive).
ARTIST_WORD_FIXES = [(r"\bDj\b", "DJ")]
SONG_WORD_FIXES = [(r"\bDj\b", "DJ"), (r"\bVs\b", "vs"), (r"\bFeat\b", "feat")]

# Bands always written with "The" (key: lower-case name without a leading "the ").
BANDS_WITH_THE = {
    "rolling stones": "The Rolling Stones",
    "beatles": "The Beatles",
    "who": "The Who",
    "police": "The Police",
    "doors": "The Doors",
    "cars": "The Cars",
    "guess who": "The Guess Who",
    "doobie brothers": "The Doobie Brothers",
    "black crowes": "The Black Crowes",
}

# Middle words kept lower-case in artist names (unless written all upper).
ARTIST_LOWER_WORDS = [
    "a", "an", "and", "as", "at", "but", "by", "for", "if", "in", "is",
    "it", "nor", "of", "on", "or", "so", "the", "to", "up", "yet", "ft",
    "feat", "vs", "v", "vs.", "with", "w/", "n", "da", "de", "del", "la",
    "le", "les", "los", "las", "el", "il", "lo",
]

# Words kept lower-case in song titles (unless first or after : ! ? .).
SONG_LOWER_WORDS = [
    "a", "an", "and", "as", "at", "but", "by", "for", "if", "in", "is",
    "it", "nor", "of", "on", "or", "so", "the", "to", "up", "yet", "with",
]

# Bands for which the "The" form always wins during name matching.
WELL_KNOWN_THE_BANDS = [
    "rolling stones", "beatles", "who", "police", "doors",
    "cars", "guess who", "doobie brothers", "black crowes",
    "eagles", "kinks", "clash", "cure", "smiths",
]

# Time formats tried in order: (Spark pattern, strptime pattern).
TIME_FORMATS = [
    ("yyyy-M-d H:m:s", "%Y-%m-%d %H:%M:%S"),
    ("M/d/yyyy H:m:s", "%m/%d/%Y %H:%M:%S"),
    ("M/d/yyyy h:m:s a", "%m/%d/%Y %I:%M:%S %p"),
    ("yyyy-M-d H:m", "%Y-%m-%d %H:%M"),
    ("M/d/yyyy H:m", "%m/%d/%Y %H:%M"),
    ("yyyy-M-d", "%Y-%m-%d"),
    ("M/d/yyyy", "%m/%d/%Y"),
]

# Default similarity threshold (0-100) for fuzzy artist matching.
DEFAULT_FUZZY_THRESHOLD = 90.0
# ------------------------------------------------------------ END FIXED VALUES

# Shape of each TIME_FORMATS entry as strptime accepts it (%Y four digits, the
# other fields one or two); a string of another shape cannot parse, so the
# parser is tried only on matching shapes.
TIME_SHAPES = [
    r"^\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}:\d{1,2}$",
    r"^\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{1,2}:\d{1,2}$",
    r"(?i)^\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{1,2}:\d{1,2} [AP]M$",
    r"^\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}$",
    r"^\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{1,2}$",
    r"^\d{4}-\d{1,2}-\d{1,2}$",
    r"^\d{1,2}/\d{1,2}/\d{4}$",
]


# A plain decimal number as Python's float() reads it (underscores allowed
# between digits); anything else falls through to NULL.
NUMBER_PATTERN = r"^[+-]?(\d(_?\d)*(\.(\d(_?\d)*)?)?|\.\d(_?\d)*)([eE][+-]?\d(_?\d)*)?$"
# An integer as Python's int() reads it.
INTEGER_PATTERN = r"^[+-]?\d(_?\d)*$"
