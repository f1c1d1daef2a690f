"""Behaviour that must equal the reference's for the same
results.  (The whitespace set and cleanup rules live next to the text
functions in ``functions/text.py``.)
"""

# --- fixed values -------------------------------------------------------------
# keep a record only when its cleaned text is longer than this many characters
MIN_CHARS = 30
# near-duplicate when the similarity is strictly greater than this
NEAR_DUP_THRESHOLD = 0.85
# length score: min(characters / LENGTH_SCORE_SCALE, LENGTH_SCORE_CAP)
LENGTH_SCORE_SCALE = 1000
LENGTH_SCORE_CAP = 5
# default category when a record has none: on write, and in statistics
DEFAULT_CATEGORY_ON_WRITE = "general"
DEFAULT_CATEGORY_IN_STATS = "unknown"
# a progress summary after every this many successes
SUMMARY_EVERY = 10
# input files whose name contains one of these words (any case) are skipped
EXCLUDED_NAME_WORDS = ("cleaned", "progress")
# nanoseconds per millisecond (latency unit conversion)

# ------------------------------------------------------------------------------
