"""Word lists, answer options, keyword rules and survey names.

Results depend on these exact strings and numbers, so they are stated here as
plain text, in their natural order.
"""

# --- Fixed values: answer options in their canonical order -----------------
OPTIONS = (
    "Math computations",
    "Writing or debugging code",
    "Data processing or analysis",
    "Explaining complex concepts simply",
    "Writing or editing essays/reports",
    "Brainstorming or generating creative ideas",
    "Drafting professional text (e.g., résumés, emails)",
    "Converting content between formats (e.g., LaTeX)",
)

# --- Fixed values: keyword -> option; the order decides the first match ----
OPTION_RULES = (
    ("math computations", "Math computations"),
    ("writing or debugging code", "Writing or debugging code"),
    ("data processing or analysis", "Data processing or analysis"),
    ("explaining complex concepts simply", "Explaining complex concepts simply"),
    ("writing or editing essays/reports", "Writing or editing essays/reports"),
    ("brainstorming or generating creative ideas",
     "Brainstorming or generating creative ideas"),
    ("drafting professional text",
     "Drafting professional text (e.g., résumés, emails)"),
    ("résumés", "Drafting professional text (e.g., résumés, emails)"),
    ("emails", "Drafting professional text (e.g., résumés, emails)"),
    ("converting content between formats",
     "Converting content between formats (e.g., LaTeX)"),
    ("latex", "Converting content between formats (e.g., LaTeX)"),
)

# --- Fixed values: the four options of the small baseline ------------------
BASELINE_TARGETS = OPTIONS[:4]

# --- Fixed values: class names in their fixed order ------------------------
CLASSES = ("ChatGPT", "Claude", "Gemini")

# --- Fixed values: stop words -----------------------------------------------
# The public English list of 179 words.
ENGLISH_STOP = tuple("""
i me my myself we our ours ourselves you you're you've you'll you'd your yours
yourself yourselves he him his himself she she's her hers herself it it's its
itself they them their theirs themselves what which who whom this that that'll
these those am is are was were be been being have has had having do does did
doing a an the and but if or because as until while of at by for with about
against between into through during before after above below to from up down in
out on off over under again further then once here there when where why how all
any both each few more most other some such no nor not only own same so than too
very s t can will just don don't should should've now d ll m o re ve y ain aren
aren't couldn couldn't didn didn't doesn doesn't hadn hadn't hasn hasn't haven
haven't isn isn't ma mightn mightn't mustn mustn't needn needn't shan shan't
shouldn shouldn't wasn wasn't weren weren't won won't wouldn wouldn't
""".split())

# Optional list of the pooled bag of words.
POOLED_STOP = ENGLISH_STOP + (
    "use", "would", "another", "often", "sometimes", "usually", "never",
)

# Short list of the per-question TF-IDF.
SHORT_STOP = (
    "the", "a", "an", "and", "or", "of", "to", "in", "on", "for", "with",
    "is", "are", "was", "were", "be", "this", "that", "it", "at", "as",
)

# List of the cleaned-and-stemmed text.
CLEAN_STOP = ENGLISH_STOP + (
    "model", "task", "use", "would", "response", "ai", "give", "asks", "asked",
)

# --- Fixed values: strings a survey file uses for a missing cell ------------
NA_STRINGS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)

# --- Fixed values: survey columns by position --------------------------------
TEXT_POSITIONS = (1, 6, 9)
RATING_POSITIONS = (2, 4, 7, 8)
MULTI_POSITIONS = (3, 5)
GROUP_COLUMN = "student_id"
LABEL_COLUMN = "label"

# --- Fixed values: the named questions ---------------------------------------
TASK_QUESTION = "In your own words, what kinds of tasks would you use this model for?"
RATING_QUESTIONS = (
    "How likely are you to use this model for academic tasks?",
    "Based on your experience, how often has this model given you a response that felt suboptimal?",
    "How often do you expect this model to provide responses with references or supporting evidence?",
    "How often do you verify this model's responses?",
)
MULTI_QUESTIONS = (
    "Which types of tasks do you feel this model handles best? (Select all that apply.)",
    "For which types of tasks do you feel this model tends to give suboptimal responses? (Select all that apply.)",
)

# --- Fixed values: sizes and search grids ------------------------------------
DEFAULT_RATING = 3
RATING_LEVELS = (1, 2, 3, 4, 5)
POSITION_CUTS = (576, 702)
KEPT_FEATURES = 420
NEIGHBOUR_COUNTS = (1, 2, 3, 4, 5, 8, 10, 15, 20, 30)
RIDGE_STRENGTHS = (0.01, 0.03, 0.1, 0.3, 1.0, 3.0)
FOREST_SIZES = (150, 200, 250, 300, 350)
FOREST_DEPTHS = (15, 20, 25, 30)
CV_TREES = (50, 100, 150, 200, 250)
CV_DEPTHS = (5, 10, 15, 20, 25)
CV_MIN_LEAF = (1, 2, 4, 8)
VOCABULARY_SIZES = (80, 90, 100, 110, 120, 130, 140)
