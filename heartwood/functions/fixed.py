"""Fixed values that results depend on, stated as text: tables, thresholds and patterns."""

# fmt: off
# --- Fixed values: document types -------------------------------------------------
RESISTANCE_NUDGE = {"action": 0.05, "journal": 0.04, "letter": 0.03, "speech": 0.02, "unknown": 0.02}
TRAINING_WEIGHT = {"action": 1.20, "journal": 1.15, "letter": 1.10, "speech": 0.90, "unknown": 1.00}
DEFAULT_SIGNIFICANCE = {"action": 0.90, "journal": 0.85, "letter": 0.80, "speech": 0.70, "unknown": 0.75}

# --- Fixed values: values, tension pairs, foundations ------------------------------
VALUES = (
    "integrity", "courage", "compassion", "commitment", "patience", "responsibility", "fairness", "gratitude",
    "curiosity", "resilience", "love", "growth", "independence", "loyalty", "humility",
)
TENSION_PAIRS = (
    ("independence", "loyalty"), ("fairness", "compassion"), ("courage", "patience"),
    ("responsibility", "humility"), ("commitment", "growth"),
)
FOUNDATIONS = {
    "care": ("compassion", "love", "gratitude"),
    "fairness": ("fairness", "responsibility"),
    "loyalty": ("loyalty", "commitment", "resilience"),
    "authority": ("responsibility", "humility"),
    "sanctity": ("integrity", "commitment"),
}
#: Values that need a first-person word near the keyword.
FIRST_PERSON_VALUES = (
    "courage", "commitment", "patience", "responsibility", "curiosity", "resilience", "growth", "independence", "humility",
)

# --- Fixed values: years ------------------------------------------------------------
YEAR_DISCOUNT = ((1400, 0.70), (1600, 0.80), (1700, 0.88), (1800, 0.93), (1850, 0.97))
AUTHENTIC, TRANSLATED, UNCERTAIN = 1.0, 0.85, 0.70

# --- Fixed values: resistance --------------------------------------------------------
BASE, SIG_SCALE, SIG_CAP, MORTAL_BONUS, HIGH_BONUS, ADVERSITY_BONUS, HOLD_EXTRA = 0.12, 0.17, 0.12, 0.62, 0.36, 0.24, 0.05
MORTAL = (
    r"\b(?:(?:I|we)\s+(?:would\s+(?:rather\s+)?)?die\b|prepared\s+to\s+die|ready\s+to\s+die|willing\s+to\s+die|"
    r"one\s+life\s+to\s+(?:lose|give)\b|gave?\s+(?:my|his|her|their|your)\s+life\s+for\b|abjure\b|sentence\s+against\s+me\b|"
    r"cannot\s+and\s+will\s+not\s+retract\b|will\s+not\s+retract\s+anything\b|execut(?:ed|ion)\b|hanged\b|beheaded\b|"
    r"burned\s+at\b|sentenced\s+to\s+death\b)"
)
HIGH_ADVERSITY = (
    r"\b(?:threaten(?:ed|s)?\s+to\b|they\s+(?:can|could|will|would|might)\s+come\s+for\s+me\b|at\s+the\s+hazard\s+of\b|"
    r"advised\s+by\s+(?:my|his|her|their)\s+(?:lawyers?|attorneys?|counsel)\b|imprison(?:ed|ment)\b|jail(?:ed)?\b|detain(?:ed|ment)\b|"
    r"exil(?:e|ed)\b|banish(?:ed)?\b|expel(?:led)?\b|persecuted?\b|persecution\b|oppressed\b|broken[\s-]hearted\b)"
)
ADVERSITY = (
    r"\b(?:even\s+though|despite|but\s+I\s+still|but\s+still|hard\s+to|difficult\s+to|I\s+have\s+to|I\s+need\s+to|"
    r"I\s+won'?t\s+give\s+up|I\s+won'?t\s+stop|I\s+still\s+believe|not\s+easy|scared\s+but|afraid\s+but|nervous\s+but|"
    r"worried\s+but|at\s+a\s+cost|at\s+my\s+own\s+expense|going\s+to\s+lose|might\s+lose|risk\s+losing|suffering\b|my\s+suffering|ruined\b)\b"
)
RESISTANCE_HOLD = (
    r"\b(?:nevertheless|nonetheless|still\s+(?:held?|continued|stood|believed?)|stood\s+firm|refused\s+to\s+give|persevered|maintained|"
    r"held?\s+(?:firm|to|my|fast)|would\s+not\s+(?:yield|surrender|give|back\s+down|flee|retreat)|will\s+not\s+yield\b|"
    r"did\s+not\s+(?:yield|flee|retreat|surrender|capitulate)|carried\s+on|pressed\s+on|kept\s+(?:faith|my)\b|"
    r"refused\s+to\s+(?:yield|surrender|flee|retreat|capitulate|back\s+down)|would\s+do\s+it\s+again\b|choose\s+to\s+stay\b)\b"
)
RESISTANCE_FAILURE = (
    r"\b(?:gave\s+in|gave\s+up|yielded|surrendered|backed\s+down|compromised\s+my|caved|relented|capitulated|gave\s+way|"
    r"stepped\s+back|gave\s+in\s+to|dropped\s+it\b)\b"
)

# --- Fixed values: structural tiers ----------------------------------------------------
TIERS = (0.30, 0.65, 1.00)
STRUCTURE = {
    "adversity": (
        r"\b(?:in\s+spite\s+of|although|even\s+though|notwithstanding|despite)\b",
        r"\b(?:at\s+(?:great\s+)?(?:personal\s+)?(?:risk|cost|price|peril)|knowing\s+(?:the\s+)?(?:cost|risk|danger|consequences?)|"
        r"at\s+the\s+expense\s+of|against\s+(?:all\s+)?(?:opposition|resistance|advice|orders|the\s+odds)|"
        r"under\s+(?:pressure|threat|fire|attack|duress|siege|interrogation)|in\s+the\s+face\s+of)\b",
        r"\b(?:risking\s+(?:everything|my\s+life|his\s+life|her\s+life|their\s+lives|my\s+career|my\s+reputation|his\s+career|her\s+career)|"
        r"sacrific(?:ing|ed)\s+(?:my|his|her|their|everything)|gave\s+(?:up\s+)?(?:everything|my\s+life|his\s+life|her\s+life)|"
        r"laid\s+down\s+(?:his|her|their|my)\s+life)\b",
    ),
    "agency": (
        r"\b(?:I|we)\s+(?:still\s+|yet\s+|nevertheless\s+|nonetheless\s+)?(?:continued|remained?|stayed?|kept\s+going|marched\s+on)\b",
        r"\b(?:I|we)\s+(?:still\s+|yet\s+|nevertheless\s+|nonetheless\s+)?"
        r"(?:refused?|chose|stood|held|pressed\s+on|carried\s+on|persisted?|rose|rebuilt?|recovered?|endured?|persevered?)\b",
        r"\b(?:I|we)\s+(?:still\s+|yet\s+|nevertheless\s+|nonetheless\s+)?"
        r"(?:did\s+not|would\s+not|could\s+not\s+(?:abandon|betray|yield|flee|lie|deceive))\b",
    ),
    "resistance": (
        r"\b(?:did\s+not\s+(?:yield|capitulate|abandon|flee|retreat|falter|waver)|never\s+(?:yielded|capitulated|fled|retreated|faltered|wavered))\b",
        r"\b(?:refused?\s+to\s+(?:yield|capitulate|surrender|give\s+up|give\s+in|back\s+down|stand\s+aside|flee|retreat)|"
        r"would\s+not\s+(?:yield|capitulate|surrender|give\s+up|give\s+in|back\s+down|stand\s+aside|be\s+silenced)|"
        r"never\s+(?:surrendered|capitulated))\b",
        r"\b(?:refused?\s+to\s+(?:abandon|betray|lie|deceive)|would\s+not\s+(?:abandon|betray|lie|deceive)|did\s+not\s+(?:betray|abandon)|"
        r"never\s+(?:betrayed|abandoned)|could\s+not\s+(?:abandon|betray|leave|forsake)\s+(?:them|him|her|the))\b",
    ),
    "stakes": (
        r"\b(?:(?:my|his|her|their|our)\s+(?:life|career|freedom|reputation|safety|livelihood|position|future|everything)\s+"
        r"(?:was\s+at\s+stake|depended\s+on\s+it|hung\s+in\s+the\s+balance))\b",
        r"\b(?:(?:threatened|warned|ordered)\s+(?:me|him|her|them|us)\s+to)\b",
        r"\b(?:(?:threatened|faced|risked)\s+(?:death|imprisonment|exile|ruin|execution|persecution)|"
        r"(?:threatened|warned)\s+(?:me|him|her|them|us)\s+with\s+(?:death|imprisonment|exile|ruin|execution|persecution)|"
        r"at\s+(?:gunpoint|knifepoint|sword(?:point)?|threat\s+of\s+death))\b",
    ),
}

# --- Fixed values: label markers ---------------------------------------------------------
FAILURE_MARKERS = (
    r"\b(gave in|gave up|yielded|surrendered|backed down|stepped back|compromised my|failed to|could not maintain|could not keep|"
    r"i betrayed|i regret|i was wrong to|i should not have|i lied|i deceived|i misled|i hid the|i concealed|i was weak|cowardice|"
    r"fear stopped|i gave up|i rationalized|made excuses|i caved|i relented|i told them what they wanted|i said what they wanted|"
    r"i pretended|i falsely|i fabricated)\b"
)
HOLD_MARKERS = (
    r"\b(despite|even though|nevertheless|nonetheless|still|continued to|stood firm|refused to give|persevered|maintained|held to|"
    r"kept to|stayed true|did not yield|would not surrender|would not give|refused to back|i admitted|i confessed|"
    r"i acknowledged my|i accepted responsibility|i owned|pushed through|carried on|pressed on|went ahead)\b"
)
PRESSURE_MARKERS = (
    r"\b(under pressure|when pressed|when threatened|when they demanded|to avoid punishment|to save myself|to protect my position|"
    r"they insisted|they demanded|forced to|compelled to|or face consequences|or be punished|or lose everything|"
    r"i told them what they wanted to hear|said what was expected)\b"
)
P1, P0, PRESSURE_SECONDS, PRESSURE_PASSAGES, PRESSURE_KEPT = 0.55, 0.35, 259_200.0, 5, 5

# --- Fixed values: keyword checks ------------------------------------------------------------
NEGATION = (
    r"\b(?:not|never|no(?:\s+longer)?|without|lacks?|lacked|lacking|fails?\s+to|failed\s+to|unable\s+to|can'?t|won'?t|didn'?t|doesn'?t|"
    r"wasn'?t|weren'?t|isn'?t|aren'?t|couldn'?t|wouldn'?t|hardly|barely|scarcely|seldom|rarely)\b"
)
NEGATING_PREFIX = r"(?:dis|un|in|ir|im|non)-?$"
FIRST_PERSON = r"\b(?:I|me|my|myself|we|our|us)\b"
DISQUALIFIERS = {
    "patience": r"\b(?:my|the|his|her|their|a|our)\s+patients?\s+\b",
    "fairness": r"\bfair\s+(?:weather|wind|sky|skies|hair|skin|complexion|use|trade|market)\b",
    "integrity": r"\bto\s+be\s+honest\s*(?:,|\bthough\b|\bwith\s+you\b|\bI\s+don['’]t\b|\babout\s+my\s+(?:schedule|day|week|plans?)\b)",
    "loyalty": r"\bdevoted?\s+(?:\w+\s+){0,2}(?:time|hours|energy|attention|resources|effort|efforts)\b",
    "love": r"\b(?:I\s+)?loves?\s+(?:pizza|coffee|tea|beer|wine|food|sports?|movies?|music|games?|this|that|it|them)\b",
    "resilience": r"\b(?:survived?|recovered?)\s+(?:from\s+)?(?:surgery|cancer|the\s+operation|chemotherapy|the\s+procedure|the\s+hospital|"
                  r"the\s+illness|the\s+disease|the\s+infection|the\s+treatment)\b",
    "commitment": r"\bI\s+will\s+(?:call|text|email|send|meet|see\s+you|be\s+there\s+at|arrive|attend\s+the|join\s+the|check|look\s+into)\b"
                  r"|\bcommitted\s+to\s+(?:the\s+)?(?:project|plan|goal|target|objective|budget|timeline|schedule|roadmap|strategy|kpi|okr)\b"
                  r"|\bcommitted\s+to\s+(?:achieving|reaching|hitting|meeting|delivering|executing|fulfilling|implementing|completing)\b"
                  r"|\bdedicated\s+to\s+(?:the\s+)?(?:gym|fitness|working\s+out|diet|exercise|routine)\b",
    "responsibility": r"\bresponsible\s+for\s+(?:the\s+)?(?:project|meeting|report|presentation|event|campaign|website|design|scheduling|"
                      r"organizing|managing|coordinating)\b",
    "gratitude": r"\bthanks?\s+(?:you\s+)?for\s+(?:joining|attending|coming|being\s+here|your\s+time|your\s+participation|your\s+presence|tuning\s+in)\b",
    "curiosity": r"\binterested\s+in\s+(?:the\s+)?(?:position|role|opportunity|job|opening|vacancy)\b",
    "humility": r"\bnot\s+above\s+(?:the\s+)?(?:law|average|minimum|maximum|sea\s+level|ground|the\s+rules)\b",
    "courage": r"\bbrave\s+face\b",
    "compassion": r"\bmoved\s+by\s+(?:the\s+)?(?:performance|film|movie|music|song|score|concert|play|book|story)\b",
    "growth": r"\bgetting\s+better\s+(?:from|after|following)\b"
              r"|\b(?:improved|improving)\s+(?:my\s+)?(?:cholesterol|blood\s+pressure|symptoms|condition|score|grade|ranking|rating|numbers?)\b",
    "independence": r"\b(?:on\s+my\s+own|by\s+myself)\s+(?:to\s+(?:the|a)\s+\w+|at\s+(?:the|a)\s+\w+|"
                    r"shopping|cooking|driving|walking|cleaning|playing|running|working\s+out)\b"
                    r"|\b(?:shopping|cooking|driving|walking|cleaning|playing|running|working\s+out)\s+(?:on\s+my\s+own|by\s+myself)\b",
}
#: Keywords that tell of a value failing; a negation before them does not count against them.
FAILURE_KEYWORDS = (
    "deceived", "lied", "misled", "concealed", "fabricated", "cowardice", "fled", "retreated", "capitulated", "indifferent", "unmoved",
    "turned away", "hardened my heart", "abandoned", "gave up", "broke my promise", "reneged", "lost patience", "could wait no longer",
    "acted rashly", "shirked", "evaded", "deflected blame", "denied responsibility", "prejudiced", "biased", "favored", "discriminated",
    "ungrateful", "took for granted", "never thanked", "incurious", "dismissed", "refused to question", "broke down", "gave in",
    "surrendered to despair", "betrayed", "deserted", "defected", "turned on", "arrogance", "arrogant", "refused to admit",
    "could not concede", "stagnated", "refused to change", "too proud to learn", "subjugated", "surrendered my autonomy",
)
#: Keywords that hold a negation themselves.
NEGATED_KEYWORD = r"not|n't|never|without|cannot"

# --- Fixed values: polarity ------------------------------------------------------------------
POSITIVE_TARGETS = (
    "right", "rights", "freedom", "liberty", "dignity", "equal", "equality", "justice", "just cause", "fair", "fairness", "truth", "honest",
    "oppressed", "vulnerable", "innocent", "victim", "victims", "the poor", "the weak", "the suffering", "the displaced", "refugee",
    "civilian", "prisoner", "enslaved", "marginalized", "peace", "humanity", "welfare", "well-being", "wellbeing", "conscience",
    "transparency", "accountability", "democracy", "human dignity", "reconciliation", "healing", "mercy", "compassion", "grace",
    "knowledge", "science", "evidence", "understanding", "reason", "life", "survival", "protection", "safety of",
)
NEGATIVE_TARGETS = (
    "tyranny", "tyrant", "oppression", "persecution", "discrimination", "cruelty", r"atrocit\w*", "massacre", "genocide", "purge",
    "extermination", "enslavement", "subjugation", "domination", "conquest", "exploitation", "torture", "suppression", "dehumanization",
    r"dehumaniz\w*", "violence against", "brutality", "terror", "ethnic cleansing", "lies", "deceit", "deception", "propaganda", "false",
    r"fabricat\w*", "corruption", "fraud", "oppressive regime", "authoritarian", "totalitarian", "apartheid", "inquisition", "pogrom",
    "hatred", "hatred of", "contempt for", "hatred toward",
)
INVERSION = (
    r"\b(?:fight(?:s|ing)?\s+against|fought\s+against|resist(?:s|ed|ing)?|oppos(?:e|es|ed|ing)|stand(?:s|ing)?\s+(?:against|up\s+to)|"
    r"stood\s+(?:against|up\s+to)|defying|defied|defi(?:es?)|refus(?:ed|es|ing)\s+to\s+(?:serve|enable|allow|support|advance|uphold)|"
    r"(?:spoke|speak|speaking)\s+(?:out\s+)?against|(?:protest(?:s|ed|ing)?|campaign(?:s|ed|ing)?|march(?:es|ed|ing)?)\s+against)"
)

# --- Fixed values: phrases ---------------------------------------------------------------------
DESTRUCTIVE = (
    r"\b(?:commit(?:ted|s|ting)?|inflict(?:ed|s|ing)?|perpetrat(?:ed|es|ing)?|orchestrat(?:ed|es|ing)?|authoriz(?:ed|es|ing)?|"
    r"authoris(?:ed|es|ing)?|sanction(?:ed|s|ing)?|order(?:ed|s|ing)?|organiz(?:ed|es|ing)?|organis(?:ed|es|ing)?|practic(?:ed|es|ing)?|"
    r"exercis(?:ed|es|ing)?|unleash(?:ed|es|ing)?|employ(?:ed|s|ing)?|propagat(?:ed|es|ing)?)\b"
)
OPPOSITION = (
    r"\b(?:resist(?:ed|s|ing)?|oppos(?:ed|es|ing)?|confront(?:ed|s|ing)?|challeng(?:ed|es|ing)?|condemn(?:ed|s|ing)?|denounc(?:ed|es|ing)?|"
    r"reject(?:ed|s|ing)?|combat(?:t?(?:ed|ing)|s)?|expos(?:ed|es|ing)?|fought\s+against|fighting\s+against|stood\s+against|"
    r"standing\s+against|stood\s+up\s+to|stands?\s+up\s+to|standing\s+up\s+to|spoke\s+against|speaking\s+against|speak(?:s)?\s+against|"
    r"campaigned\s+against|campaign(?:s|ing)?\s+against|worked\s+against|work(?:s|ing)?\s+against|protest(?:ed|s|ing)?(?:\s+against)?)\b"
)
RECIPIENT = r"\b(?:against|toward|towards|upon|at)\s+(\w+)\b"
SUBJECTS = {"he": ("he", "his"), "she": ("she", "her", "hers"), "they": ("they", "their"), "i": ("i", "we", "my", "our")}
OBJECTS = {"he": ("him", "his"), "she": ("her", "hers"), "they": ("them", "their"), "i": ("me", "us")}
ANY_SUBJECT = ("he", "she", "they", "it", "those", "others", "one", "we", "i")
PHRASE_CONFIDENCE, VERB_WINDOW, SUBJECT_WINDOW, OBJECT_WINDOW = 0.58, 60, 30, 40

# --- Fixed values: archaic forms ------------------------------------------------------------------
ARCHAIC = (
    ("'tis", "it is"), ("'twas", "it was"), ("'twere", "it were"), ("'twill", "it will"), ("thou", "you"), ("thee", "you"), ("thy", "your"),
    ("thine", "your"), ("ye", "you"), ("hath", "has"), ("doth", "does"), ("sayeth", "says"), ("goeth", "goes"), ("cometh", "comes"),
    ("knoweth", "knows"), ("seeth", "sees"), ("taketh", "takes"), ("maketh", "makes"), ("giveth", "gives"), ("liveth", "lives"),
    ("art", "are"), ("wast", "were"), ("wert", "were"), ("shouldst", "should"), ("wouldst", "would"), ("couldst", "could"),
    ("mightst", "might"), ("dost", "do"), ("didst", "did"), ("canst", "can"), ("wilt", "will"), ("hast", "have"), ("nay", "no"), ("yea", "yes"),
)

# --- Fixed values: lexicon and layers ------------------------------------------------------------
LEXICON_CONFIDENCE, LEXICON_BOOST, LEXICON_NEUTRAL, LEXICON_SPAN, LEXICON_FLOOR = 0.55, 0.15, 5.5, 4.5, 0.20
LEXICON_STANDALONE, SEMANTIC_THRESHOLD, SEMANTIC_TOP = 0.55, 0.45, 3

# --- Fixed values: foundation classifier -----------------------------------------------------------
CLASSIFIER_LABELS = {
    "LABEL_0": ("care", "virtue"), "LABEL_1": ("care", "vice"), "LABEL_2": ("fairness", "virtue"), "LABEL_3": ("fairness", "vice"),
    "LABEL_4": ("loyalty", "virtue"), "LABEL_5": ("loyalty", "vice"), "LABEL_6": ("authority", "virtue"), "LABEL_7": ("authority", "vice"),
    "LABEL_8": ("sanctity", "virtue"), "LABEL_9": ("sanctity", "vice"),
}
CLASSIFIER_VALUES = {
    "care": ("compassion", "love", "gratitude"),
    "fairness": ("fairness", "responsibility", "integrity"),
    "loyalty": ("loyalty", "courage", "commitment", "resilience"),
    "authority": ("responsibility", "humility"),
    "sanctity": ("integrity", "commitment"),
}
DEFIANCE_VALUES, DEFIANCE_DISCOUNT = ("independence",), 0.70

# --- Fixed values: dataset quality ------------------------------------------------------------------
QUALITY = {
    "min_records": 20, "value_coverage_min": 5, "label_max_pct": 0.80, "avg_confidence_min": 0.65, "resistance_spread_min": 0.10,
    "source_diversity_min": 2, "disambiguation_rate_min": 0.85, "consistency_pct5_min": 0.25, "text_quality_min_chars": 30,
    "text_quality_rate_min": 0.90, "per_figure_min_records": 5, "p1_coherence_min": 0.85, "reason_coherence_min": 0.95, "conflict_max": 0.05,
}
MARKER_REASONS = ("apy_resistance_held_under_pressure", "high_resistance_hold_marker", "pressure_detected_value_failed", "panel_confirmed_p1")
SWEEP_P1, SWEEP_P0 = (0.35, 0.40, 0.45, 0.50, 0.55, 0.60, 0.65, 0.70), (0.20, 0.25, 0.30, 0.35, 0.40, 0.45)
# fmt: on
