"""Lists and constants that decide the results. All are plain text."""

# --- Corpus contract -------------------------------------------------------
CORPUS_COLUMNS = ("id", "keyword", "location", "text", "target")
LABELS = (0, 1)
CATEGORY_NAMES = {0: "No desastre", 1: "Desastre real"}

# Tokens a CSV reader takes as a missing value (fixed values).
MISSING_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# --- Cleaning --------------------------------------------------------------
# The 32 ASCII punctuation characters (fixed values).
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"

# Contractions in the order in which they are expanded (fixed values).
CONTRACTIONS = (
    ("won't", "will not"),
    ("can't", "can not"),
    ("n't", " not"),
    ("'re", " are"),
    ("'ve", " have"),
    ("'ll", " will"),
    ("'d", " would"),
    ("'m", " am"),
)

EMERGENCY_NUMBER = "911"
EMERGENCY_WORD = "nineoneone"

# Words that negate and are therefore never dropped (fixed values).
NEGATORS = ("no", "nor", "not", "never", "neither", "none", "cannot")

# Platform words dropped besides the base list (fixed values).
EXTRA_STOP_WORDS = ("rt", "amp", "https", "http", "co", "im", "u", "ur")

# Base English stop-word list, public Glasgow list (fixed values, alphabetic order).
BASE_STOP_WORDS = tuple(
    """
    a about above across after afterwards again against all almost alone along already also
    although always am among amongst amoungst amount an and another any anyhow anyone anything
    anyway anywhere are around as at back be became because become becomes becoming been before
    beforehand behind being below beside besides between beyond bill both bottom but by call can
    cannot cant co con could couldnt cry de describe detail do done down due during each eg eight
    either eleven else elsewhere empty enough etc even ever every everyone everything everywhere
    except few fifteen fifty fill find fire first five for former formerly forty found four from
    front full further get give go had has hasnt have he hence her here hereafter hereby herein
    hereupon hers herself him himself his how however hundred i ie if in inc indeed interest into
    is it its itself keep last latter latterly least less ltd made many may me meanwhile might mill
    mine more moreover most mostly move much must my myself name namely neither never nevertheless
    next nine no nobody none noone nor not nothing now nowhere of off often on once one only onto
    or other others otherwise our ours ourselves out over own part per perhaps please put rather re
    same see seem seemed seeming seems serious several she should show side since sincere six sixty
    so some somehow someone something sometime sometimes somewhere still such system take ten than
    that the their them themselves then thence there thereafter thereby therefore therein thereupon
    these they thick thin third this those though three through throughout thru thus to together
    too top toward towards twelve twenty two un under until up upon us very via was we well were
    what whatever when whence whenever where whereafter whereas whereby wherein whereupon wherever
    whether which while whither who whoever whole whom whose why will with within without would yet
    you your yours yourself yourselves
    """.split()
)
STOP_WORDS = tuple(sorted((set(BASE_STOP_WORDS) | set(EXTRA_STOP_WORDS)) - set(NEGATORS)))

# Stop-words that carry meaning of their own, flagged by the audit (fixed values).
CONTENT_STOP_WORDS = tuple(
    """
    fire cry call serious system front back side top bottom full empty move show find part well
    bill detail amount interest describe fill thick thin hundred mill sincere
    """.split()
)
MIN_STOP_WORD_DOCUMENTS = 25

# Words of the negation flag (fixed values).
NEGATION_WORDS = ("no", "not", "never", "none", "nor", "neither", "cannot", "n't")

# --- Sentiment -------------------------------------------------------------
POSITIVE_THRESHOLD = 0.05
NEGATIVE_THRESHOLD = -0.05
SENTIMENT_LABELS = ("negativo", "neutral", "positivo")
THRESHOLD_SOURCE = "Hutto y Gilbert (2014)"
NEGATIVITY_EDGES = (-0.001, 0.0, 0.2, 0.4, 0.6, 0.8, 1.0)
WORD_TYPES = {
    "pos_word_count": "Positivas",
    "neg_word_count": "Negativas",
    "neu_word_count": "Neutrales",
}

# Constants of the published rule set (Hutto and Gilbert 2014; fixed values).
BOOST = 0.293
CAPS_BOOST = 0.733
NEGATION_FACTOR = -0.74
NEVER_FACTOR = 1.25
DISTANCE_DAMPING = (1.0, 0.95, 0.9)
BUT_BEFORE, BUT_AFTER = 0.5, 1.5
EXCLAMATION_WEIGHT, EXCLAMATION_LIMIT = 0.292, 4
QUESTION_WEIGHT, QUESTION_LIMIT, QUESTION_CEILING = 0.18, 3, 0.96
NORMALISER = 15.0

# Intensifiers and dampeners of the published rule set (fixed values).
INTENSIFIERS = tuple(
    """
    absolutely amazingly awfully completely considerable considerably decidedly deeply effing
    enormous enormously entirely especially exceptional exceptionally extreme extremely fabulously
    flipping flippin frackin fracking fricking frickin frigging friggin fully fuckin fucking fuggin
    fugging greatly hella highly hugely incredible incredibly intensely major majorly more most
    particularly purely quite really remarkably so substantially thoroughly total totally
    tremendous tremendously uber unbelievably unusually utter utterly very
    """.split()
)
DAMPENERS = tuple(
    """
    almost barely hardly kinda kindof kind-of less little marginal marginally occasional
    occasionally partly scarce scarcely slight slightly somewhat sorta sortof sort-of
    """.split()
)
DAMPENER_PHRASES = ("just enough", "kind of", "sort of")

# Negating words of the published rule set (fixed values).
SENTIMENT_NEGATORS = tuple(
    """
    aint arent cannot cant couldnt darent didnt doesnt ain't aren't can't couldn't daren't didn't
    doesn't dont hadnt hasnt havent isnt mightnt mustnt neither don't hadn't hasn't haven't isn't
    mightn't mustn't neednt needn't never none nope nor not nothing nowhere oughtnt shant shouldnt
    uhuh wasnt werent oughtn't shan't shouldn't uh-uh wasn't weren't without wont wouldnt won't
    wouldn't rarely seldom despite
    """.split()
)

# Idioms with a valence of their own (fixed values).
IDIOMS = {
    "the shit": 3.0,
    "the bomb": 3.0,
    "bad ass": 1.5,
    "badass": 1.5,
    "bus stop": 0.0,
    "yeah right": -2.0,
    "kiss of death": -1.5,
    "to die for": 3.0,
    "beating heart": 3.1,
    "broken heart": -2.9,
}

# --- Contrast --------------------------------------------------------------
# Upper bounds of the effect-size names (Romano et al. 2006; fixed values).
EFFECT_SIZES = ((0.147, "insignificante"), (0.330, "pequeño"), (0.474, "mediano"))
LARGEST_EFFECT = "grande"
BOOTSTRAP_RESAMPLES = 10_000
CONFIDENCE = 0.95

# --- Models ----------------------------------------------------------------
SEED = 42
TEST_SHARE = 0.20
MIN_DOCUMENTS = 2
MAX_DOCUMENT_SHARE = 0.98
MAX_TERMS = 35_000
NAIVE_BAYES_SMOOTHING = 0.5
LOGISTIC_C = 2.0
SVM_C = 0.75
CALIBRATION_FOLDS = 3
MAX_ITERATIONS = 2_000
DECISION_THRESHOLD = 0.5
F1_TOLERANCE = 0.002

BASELINE_MODEL = "Baseline mayoritaria"
NAIVE_BAYES_MODEL = "Naive Bayes complementario"
LOGISTIC_MODEL = "Regresión logística"
SVM_MODEL = "SVM lineal calibrado"
MODEL_A = "A · TF-IDF sin negatividad"
MODEL_B = "B · TF-IDF con negatividad"
FAMILY_FIRST = "preliminar"
FAMILY_SECOND = "reentrenamiento"

FALSE_POSITIVE = "Falso positivo"
FALSE_NEGATIVE = "Falso negativo"
CORRECT = "Acierto"
BETTER, WORSE, SAME = "mejora", "empeora", "sin cambio"

TOP_POSITIVE = "Top 10 positivos"
TOP_NEGATIVE = "Top 10 negativos"

# Raw texts scored end to end as a demonstration (fixed values).
DEMO_TEXTS_FIRST = (
    "Massive fire near the city, residents are evacuating now!",
    "That movie was a total disaster lol 😂",
    "Emergency services report flooding on the highway.",
)
DEMO_TEXTS_FINAL = (
    "Massive fire near the city, residents are evacuating now! #wildfire https://t.co/abc",
    "That movie was a total disaster lol 😂 @friend",
    "Emergency services report flooding on the highway, call 911 immediately.",
    "I can't believe how great this party is!! 🎉",
    "BREAKING: 7.1 earthquake collapses buildings downtown, rescue teams deployed",
    "My exam results were a train wreck, I'm devastated",
)
DEMO_TEXTS_NOTEBOOK = (
    "Emergency services report a wildfire evacuation near the city",
    "That movie was a total disaster but we laughed all night 😂",
    "Flash flood warning: move to higher ground now!",
    "Lovely weather for the concert tonight :)",
)
