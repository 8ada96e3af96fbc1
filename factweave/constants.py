"""Fixed values.

The first block must equal the values of the original system for equal results; they
are stated as plain text, in their natural order. The second block holds our own
defaults (lexicon of the annotator, confidence weights, normaliser word lists).
"""

# ---------------------------------------------------------------------------
# FIXED VALUES (must match the original system)
# ---------------------------------------------------------------------------

# Type strings that never count as a type of an argument.
TYPE_BLACKLIST = [
    "/tv/tv_subject",
    "/book/book_subject",
    "/film/film_subject",
    "/media_common/media_genre",
    "/media_common/quotation_subject",
    "/internet/website_category",
    "/book/literary_genre",
    "/book/magazine_genre",
    "/award/award_discipline",
    "/tv/tv_genre",
    "/book/periodical_subject",
    "/exhibitions/exhibition_subject",
    "/symbols/flag_referent",
    "/influence/influence_node",
]
# Types with this prefix are dropped as well.
TYPE_DROP_PREFIX = "/base/"

# Arguments that are exactly one of these words are never typed.
ARG_STOP_WORDS = ["one", "two", "three", "four", "five", "some", "any", "all"]
MIN_ARG_LENGTH = 4          # arguments shorter than this are neither typed nor joined
MIN_REL_LENGTH = 4          # relation strings of length <= 3 are dropped
MAX_REL_LENGTH = 100        # ... and longer than 100

# Typer settings as a command-line run uses them.
MAX_SIMILAR_ENTITIES = 15
MAX_PREDICTED_TYPES = 5
MIN_SHARE_SCORE = 10
MIN_REL_WEIGHT = 0.10
MAX_ENTITIES_WRITE_PER_REL = 150
MAX_REL_INFOS_READ_PER_ARG = 20_000
MAX_ARGS_PER_REL_INFO = 1_000
TOP_FBIDS_IN_PREDICTION = 5
NOTABLE_RELS = 4

# Re-link rule of the upsert: size > 1 and (size < 5 or size even).
RELINK_MIN_EXCLUSIVE = 1
RELINK_SMALL_EXCLUSIVE = 5

# Text escapes of the intermediate formats.
ESC_TAB = "_TAB_"
ESC_COLON = "_COLON_"
ESC_AT = "_ATSYM_"

# ---------------------------------------------------------------------------
# OUR DEFAULTS (the original delegates these to libraries outside its tree)
# ---------------------------------------------------------------------------

# Closed-class lexicon of the default annotator: word -> Penn tag.
LEXICON = {
    "the": "DT", "a": "DT", "an": "DT", "this": "DT", "that": "DT", "these": "DT", "those": "DT",
    "of": "IN", "in": "IN", "on": "IN", "by": "IN", "for": "IN", "with": "IN", "from": "IN",
    "at": "IN", "as": "IN", "into": "IN", "about": "IN", "over": "IN", "under": "IN",
    "to": "TO",
    "and": "CC", "or": "CC", "but": "CC",
    "it": "PRP", "he": "PRP", "she": "PRP", "they": "PRP", "we": "PRP", "i": "PRP", "you": "PRP",
    "is": "VBZ", "was": "VBD", "are": "VBP", "were": "VBD", "be": "VB", "been": "VBN", "being": "VBG",
    "has": "VBZ", "had": "VBD", "have": "VBP",
    "will": "MD", "would": "MD", "can": "MD", "could": "MD", "may": "MD", "might": "MD",
    "shall": "MD", "should": "MD", "must": "MD",
    "not": "RB", "very": "RB", "also": "RB",
}

# Words the key normaliser removes from relation phrases.
REL_DROP_WORDS = [
    "a", "an", "the", "is", "was", "are", "were", "be", "been", "being",
    "will", "would", "can", "could", "may", "might", "shall", "should", "must",
    "also", "very", "really", "just", "not",
]

# Words whose singular or base form the suffix rules of the key normaliser (functions.stem_tokens) do not give.
STEM_EXCEPTIONS = {
    "always": "always", "buses": "bus", "children": "child", "cookies": "cookie", "does": "do", "echoes": "echo",
    "economics": "economics", "feet": "foot", "gases": "gas", "geese": "goose", "goes": "go", "halves": "half",
    "headquarters": "headquarters", "heroes": "hero", "knives": "knife", "leaves": "leaf", "lens": "lens", "lenses": "lens",
    "mathematics": "mathematics", "means": "means", "men": "man", "mice": "mouse", "movies": "movie", "news": "news",
    "perhaps": "perhaps", "physics": "physics", "politics": "politics", "potatoes": "potato", "series": "series",
    "shelves": "shelf", "species": "species", "teeth": "tooth", "tomatoes": "tomato", "towards": "towards",
    "wives": "wife", "wolves": "wolf", "women": "woman",
}

# Confidence model: intercept and one weight per boolean feature (our configuration).
CONF_INTERCEPT = -0.5
CONF_WEIGHTS = {
    "covers_sentence": 1.2,      # arg1 + rel + arg2 cover every token
    "starts_sentence": 0.4,      # arg1 starts at token 0
    "short_sentence": 0.6,       # at most 10 tokens
    "long_sentence": -0.8,       # more than 20 tokens
    "rel_ends_prep": 0.3,        # relation ends in a preposition
    "rel_single_verb": -0.4,     # relation is one token
    "arg2_ends_sentence": 0.5,   # arg2 is the last phrase
    "arg_has_digit": -0.3,       # an argument contains a digit
}
