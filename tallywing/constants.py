"""Values fixed by the data format and the published task definitions."""

# Spellings of "missing" found in the data besides SQL null.
NULL_MARKER = "NULL"
UNKNOWN = "Unknown"

# Sentiment domain.
SENTIMENTS = ("positive", "negative", "neutral")

# Sentiment thresholds.
THRESHOLD = 0.1
HIGHER_THRESHOLD = 0.2
LOWER_THRESHOLD = 0.05
COMPOUND_THRESHOLD = 0.05
COMPOUND_ALPHA = 15.0

# Words that flip the next scored word.
NEGATIONS = ("not", "never", "no", "nobody", "none", "nor", "nothing", "nowhere")

# Parts of speech whose words carry a score (noun, adjective, adverb).
SCORED_POS = ("n", "a", "r")

# First letter of a treebank tag and the lexicon part of speech it stands for.
TREEBANK_POS = {"J": "a", "V": "v", "N": "n", "R": "r"}

# Timestamp layouts. Crowd-work columns put the month first, tweets the day.
WORK_TIME_FORMATS = ("M/d/yyyy H:mm:ss", "M/d/yyyy H:mm")
TWEET_TIME_FORMATS = ("d/M/yyyy H:mm:ss", "d/M/yyyy H:mm")

# Fixed values: "latitude,longitude" inside free text.
COORDINATE_PATTERN = r"([\+-]?\d+(?:\.\d+)?),\s?([\+-]?\d+(?:\.\d+)?)"

# Planar distance, in degrees, up to which a point belongs to a country.
COUNTRY_REACH = 30.0

# Columns that identify one judgement of one tweet.
DEDUP_KEYS = ("tweet_id", "_id", "text", "tweet_created", "name", "_created_at")

# Columns left out of the cleaned table.
CLEAN_DROP = ("negativereason_gold", "negativereason", "_region", "_city", "_tainted")
SENTIMENT_DROP = ("_region", "_city", "_tainted")

# Output columns of the sentiment task, in the order they are added.
LABEL_COLUMNS = (
    "sentiment",
    "sentiment_without_stop_words",
    "get_sentiment_inverse_if_negative",
    "get_sentiment_higher_threshold",
    "get_sentiment_lower_threshold",
    "get_sentiment_vader",
)
