"""Values that decide the results and therefore have to be exactly these."""

import string

# --- fixed values: characters -------------------------------------------------
# The whitespace class of the source texts; Java's \s alone covers only ASCII.
WHITESPACE = r"[\s\x1c-\x1f\x85\p{Z}]"
DIACRITICS = "".join(map(chr, range(0x064B, 0x0660)))
TATWEEL = "ـ"
ALEF_FORMS = "آأإ"  # with madda, hamza above, hamza below
ALEF = "ا"
TEH_MARBUTA = "ة"
HEH = "ه"
PUNCTUATION = "،؛؟«»…" + TATWEEL + string.punctuation
LATIN_LETTERS = string.ascii_letters
DIGITS = (
    string.digits
    + "".join(map(chr, range(0x0660, 0x066A)))
    + "".join(map(chr, range(0x06F0, 0x06FA)))
)
NOT_ARABIC = r"[^؀-ۿݐ-ݿ]+"

# --- fixed values: words and affixes ------------------------------------------
STOPWORDS = [
    "في", "من", "إلى", "على", "عن", "مع", "كان", "هذا", "هذه", "ذلك",
    "تلك", "هو", "هي", "هم", "هن", "أن", "إن", "ما", "لا", "هل",
    "أي", "كل", "بعض", "لم", "لن", "قد", "لقد", "إنه", "إنها", "حتى",
    "بعد", "قبل", "عند", "تحت", "فوق", "بين", "خلال", "حول", "حيث", "هناك",
    "هنا", "ثم", "أو", "و", "ف", "ب", "ل", "ك", "ا", "فقد",
    "بل", "لكن", "ليس", "ليست", "كن", "تكون", "يكون", "كانت", "كانوا",
]
PREFIXES = [
    "ال", "س", "ف", "و", "ل", "ب", "ت", "ي", "ن", "أ",
    "إ",
]
SUFFIXES = [
    "ها", "هم", "هن", "كما", "كم", "كن", "نا", "ني", "وا", "ون", "ين", "ات", "ان", "ية",
]
STEM_PASSES = 3
STEM_MIN_REST = 2  # letters an affix must leave behind

# --- fixed values: text classification features -------------------------------
TERM = r"[\p{L}\p{N}_]{2,}"
MAX_FEATURES = 5000
NGRAM_RANGE = (1, 2)
TEST_SIZE = 0.2
SEED = 42
REGULARIZATION_GRID = (0.1, 1.0, 10.0)
GRID_FOLDS = 3

# --- fixed values: sequence models --------------------------------------------
IGNORED_LABEL = -100
TAGGER_MAX_LENGTH = 128
SUMMARY_MAX_INPUT = 512
SUMMARY_MAX_TARGET = 128
SEQUENCE_TEST_SIZE = 0.1
BATCH_SIZE = 32
