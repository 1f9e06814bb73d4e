"""Fixed values that results depend on, in one place."""

# Unicode classes for regular expressions; Java's bare \w and \s are ASCII only. Letters and digits
# of ASCII are listed because the matcher looks them up in a table before it tries the classes.
WORD_CHARS = r"a-zA-Z0-9_\p{L}\p{N}"
SPACE_CHARS = r"\s\x{0B}\x{1C}-\x{1F}\x{85}\p{Z}"
BLANKS = (
    " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\u00a0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Placeholders and punctuation kept by the text cleaning.
URL_PATTERN = rf"https?://[^{SPACE_CHARS}]+"
MENTION_PATTERN = rf"@[{WORD_CHARS}]+"
HASHTAG_PATTERN = rf"#([{WORD_CHARS}]+)"
URL_PLACEHOLDER = " URL "
MENTION_PLACEHOLDER = " USER "
KEPT_PUNCTUATION = ".,?!"

# Author part of a post address.
AUTHOR_PATTERN = r"x\.com/([^/]+)/status"

# Thresholds.
MIN_TOKENS = 5
MIN_TERM_LENGTH = 4
MIN_REPEATED_WORDS = 10
COORDINATED_AUTHORS = 5
ENTROPY_EPSILON = 1e-12
HIGH_ENTROPY = 0.8
ALERT_PERCENT = 30.0
TAIL_FACTOR = 1.3
URL_LENGTH = 512
REVIEW_QUEUE_ROWS = 100
HISTOGRAM_BINS = 50

# Right-closed confidence buckets; the lowest edge belongs to the first bucket.
CONFIDENCE_EDGES = [0.0, 0.5, 0.7, 0.85, 0.95, 1.0]
CONFIDENCE_LABELS = ["<50%", "50-70%", "70-85%", "85-95%", ">95%"]

WEEKDAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]

# Loose truth words of raw files; anything else counts as false.
TRUE_WORDS = ["true", "1", "yes"]

# Words the typed export understands; anything else becomes null.
STRICT_TRUE = ["true", "1"]
STRICT_FALSE = ["false", "0"]
