"""Word lists, patterns and lookup tables whose exact content decides results.

Regexes are in the common subset of Java and RE2 unless a name ends in _JAVA.
"""

STOPWORDS = frozenset(
    """a an and are as at be but by for from had has have he her his if in is it its may
    not of on or our per she so that the their them then there these they this to was we were will
    with would you your can could should does do did what which who whom when where why how both
    each few more most other some such only own same too very just also than into over under again
    further once upon""".split()
)
K1, B, HIT_RANKS, QUERY_TERMS = 1.5, 0.75, (1, 3, 5, 10), 12

# --- audit and repair
PIRACY_TRIGGERS = [r"Medical Higher Study", r"apps?\.apple\.com", r"play\.google\.com", r"Join.*[Tt]elegram", r"t\.me/", r"bit\.ly/", r"[\x{0980}-\x{09ff}]{5,}"]
ICON_LINES = [r"^Information icon:.*$", r"^Information icon\s*$", r"^Section header icon:.*$", r"^Medical\s*$", r"^HIGHER STUDY\s*$"]
CLINICAL_KEYWORDS = (
    r"(?i)\b\d+(?:\.\d+)?\s*(?:mg|mcg|g|mL|units?|IU|mmol/L|mg/dL|%|mg/kg|mcg/kg/min|mL/min|mg/m2|kPa|mmHg)\b|"
    r"\b(?:stat|IV|oral|intramuscular|subcutaneous|infusion|loading dose|maintenance dose|contraindicated|indicated|first-line|second-line|treatment|therapy|diagnosis|"
    r"management|administer|prescribe|resuscitate|immediately|caution|warning)\b"
)
PROTECTED_SHAPES = [r"^<!--\s*(?:page|pdf_page):", r"^#{1,4}\s", r"^\|", r"^-?\s*[A-E][\.\)]\s", r"^(?:Answer|Q\d)", r"^\d+(?:\.\d+)*\.\s", r"^[-*•]\s"]

# --- fidelity detectors: check -> patterns, matched without case
DETECTORS = {
    "numeric": [r"\b\d+(?:\.\d+)?\b"],
    "unit": [r"\b\d+(?:\.\d+)?\s*(?:mg|mcg|g|mL|units?|IU|mmol/L|mg/dL|%|mg/kg|mcg/kg/min|mcg/min|mL/min(?:/1\.73m2)?|mg/m2|g/m2|kPa|mmHg|cmH2O|ng/mL|pg/mL|pmol/L|micromol/L|IU/kg|units/hr)\b"],
    "inequality": [r"[<>≤≥]", r"\bless than\b", r"\bgreater than\b", r"\bat least\b", r"\bat most\b", r"\bor more\b", r"\bor fewer\b"],
    "range": [r"\b\d+\s*[-–]\s*\d+\b", r"\b\d+\s+to\s+\d+\b"],
    "dose": [r"\b\d+(?:\.\d+)?\s*(?:mg|mcg|g|mL|units?|IU|mg/kg|mcg/kg/min|mcg/min|mg/m2|IU/kg|units/hr)\b", r"\b(?:once|twice|three times)\s+(?:daily|weekly)", r"\b(?:loading|maintenance)\s+dose\b"],
    "duration": [r"\b\d+\s*(?:day|week|month|year|hour|min)s?\b"],
    "frequency": [r"\b(?:once|twice|three times)\s+(?:daily|weekly)\b", r"\bevery\s+\d+\s*(?:hours?|hrs?)\b", r"\bq\d+h\b", r"\bbd\b", r"\btds\b", r"\bod\b", r"\bprn\b"],
}
NEGATION_PAIRS = [("not indicated", "indicated"), ("not recommended", "recommended"), ("contraindicated", "permitted"), ("should not", "should")]
POLARITY_PAIRS = [("increase", "decrease"), ("increases", "decreases"), ("positive", "negative"), ("associated with", "not associated with"), ("before", "after")]
SEQUENCE_MARKERS = [r"\bfirst-line\b", r"\bsecond-line\b", r"\binitial\b", r"\bconfirmatory\b", r"\bthen\b", r"\bfollowed by\b", r"^\s*\d+\.\s"]
REQUIRED_DETECTORS = ["boundary_loss", "dose", "duration", "frequency", "inequality", "negation", "numeric", "polarity", "range", "sequence", "unit"]
DRUG_DOSE = r"\b([A-Z][a-z]+(?:in|ol|ide|ate|azole|cillin|mycin)?)\b[^.\n]{0,40}(\d+(?:\.\d+)?\s*(?:mg|mcg|g|mL|units?|IU)\b)"
DOSING = [r"\b\d+\s*(?:mg|mcg|g|mL|units?|IU)\b", r"\b(?:once|twice|three times)\s+(?:daily|weekly)", r"\b(?:loading|maintenance)\s+dose\b", r"\b\d+(?:\.\d+)?\s*(?:mg/kg)\b"]
THRESHOLDS = [r"\b\d+(?:\.\d+)?%\b", r"\b(?:eGFR|CrCl)\s*[<>]\s*\d+", r"\bnumber needed to treat\b", r"\bNNT\b", r"\b(?:sensitivity|specificity)\s*(?:of\s*)?\d+"]

# --- chunk metadata ladders
TITLE_TYPES = [
    ("drug_info", ["adverse effect", "anti-arrhythmic", "drug", "pharmacotherapy", "dosing", "dose"]),
    ("laboratory_investigation", ["investigation", "biomarker", "troponin", "ecg", "echocardiograph", "x-ray", "catheterisation", "mri", "ct"]),
    ("management_step", ["management", "treatment", "resuscitation", "therapy", "cardioversion", "ablation", "surgery", "pci", "cabg", "pericardiocentesis", "pacemaker"]),
    ("clinical_feature", ["clinical feature", "symptom", "sign", "presentation", "murmur", "pulse", "jvp", "examination"]),
    ("diagnostic_criteria", ["criteria", "score", "classification", "nyha", "ccs", "duke", "jones"]),
    ("pathophysiology", ["pathogenesis", "pathophysiology", "anatomy", "physiology", "mechanism", "aetiology", "cause"]),
    ("epidemiology_concept", ["epidemiology", "prevalence", "incidence", "risk factor", "prognosis", "in old age", "in adolescence"]),
]
SCORING_WORDS = ["score", "scoring system", "curb-65", "wells", "cha2ds2", "has-bled", "meld", "gcs", "glasgow coma", "nyha class", "child-pugh", "apache", "timi"]
SCORING_SHAPE = r"\b\d+\s*(?:points?|pts?)\b|\bscore\s*[:=≥><]\s*\d+"
ESCALATION_WORDS = ["step 1", "step 2", "step 3", "stepwise", "first-line", "second-line", "third-line", "stage 1", "stage 2", "escalat", "titrat"]
ESCALATION_SHAPES = [r"(?s)\bstep\s*1\b.*?\bstep\s*2\b", r"(?s)\bfirst-line\b.*?\bsecond-line\b"]
TREE_WORDS = ["algorithm", "flowchart", "decision tree", "diagnostic pathway", "management pathway", "clinical pathway", "if suspected"]
TREE_SHAPE = r"(?s)\bif\b.*?\b(?:then|proceed to|consider|indicated|perform)\b"
TREE_CUES = ["low risk", "high risk", "positive", "negative"]
EMERGENCY_WORDS = ["emergency", "resuscitation", "immediate management", "cardiac arrest", "anaphylaxis", "status epilepticus", "tension pneumothorax", "severe shock", "overdose management", "acute poisoning", "acute severe", "life-threatening"]
URGENT_WORDS = ["urgent", "unstable", "rapidly progressive", "impending", "red flag", "admission criteria", "deterioration", "monitoring in icu", "high risk"]
DRUG_SYNONYMS = {
    "paracetamol": ["acetaminophen", "tylenol"], "acetaminophen": ["paracetamol"], "adrenaline": ["epinephrine"], "epinephrine": ["adrenaline"],
    "noradrenaline": ["norepinephrine"], "norepinephrine": ["noradrenaline"], "salbutamol": ["albuterol"], "albuterol": ["salbutamol"],
    "frusemide": ["furosemide", "lasix"], "furosemide": ["frusemide", "lasix"], "pethidine": ["meperidine"], "meperidine": ["pethidine"],
    "lignocaine": ["lidocaine"], "lidocaine": ["lignocaine"], "bendroflumethiazide": ["thiazide"], "diamorphine": ["heroin", "diacetylmorphine"],
    "glyceryl trinitrate": ["nitroglycerin", "gtn"], "nitroglycerin": ["glyceryl trinitrate", "gtn"], "isoprenaline": ["isoproterenol"], "isoproterenol": ["isoprenaline"],
    "rifampicin": ["rifampin"], "rifampin": ["rifampicin"], "methohexitone": ["methohexital"], "thiopentone": ["thiopental"],
    "amoxicillin": ["amoxycillin"], "amoxycillin": ["amoxicillin"], "ciclosporin": ["cyclosporine"], "cyclosporine": ["ciclosporin"],
}
TITLE_RULES = [
    ("drug_info", [r"^Adverse effects of", r"adverse effects of \w+", r"^Drugs?/toxins$", r"^Pharmacologic(?:al)? (?:therapy|treatment|approaches)$"]),
    ("laboratory_investigation", [r"^Investigations?$", r"^Plain X-rays?$", r"^Ultrasonograph", r"^Computed tomography$", r"^Magnetic resonance imaging$", r"^Radionuclide bone scintigraphy$", r"^Dual X-ray absorptiometry$",
                                  r"^Electromyography$", r"^Tissue biopsy$", r"^Screening and Diagnostic Tests?$", r"^(?:HbA1c|CGM|Continuous Glucose Monitoring|eGFR|Albuminuria)$"]),
    ("diagnostic_criteria", [r"^Diagnostic [Cc]riteria$", r"^Classification [Cc]riteria$"]),
    ("management_step", [r"^Management$", r"^Surgery$", r"^Prophylaxis$", r"^Non-pharmacological (?:therapy|interventions)$", r"^Pharmacological (?:therapy|treatment|interventions)$", r"^Recommendations?(?:\s+\d+(?:\.\d+)?)?$",
                         r"^Glycemic Targets?$", r"^Blood Pressure Management$", r"^Lipid Management$", r"^Lifestyle Management$"]),
    ("pathophysiology", [r"^Pathophysiology$", r"^Pathogenesis$", r"^Etiology$", r"^Aetiology$"]),
]
BODY_RULES = [
    ("drug_info", [r"\b\d+\s*(?:mg|mcg|g|mL)\b", r"\bdosing\b", r"\bregimen\b", r"\bpharmacokinetic", r"\bhalf-life\b", r"\bantibiot", r"\bantiviral", r"\bbioavailability\b", r"\bside effects?\b", r"\badverse effects?\b"]),
    ("laboratory_investigation", [r"\bsensitivity\b", r"\bspecificity\b", r"\blikelihood ratio\b", r"\bpre-test\b", r"\bpost-test\b"]),
    ("pathophysiology", [r"\bconsists? of\b", r"\bis composed of\b", r"\bcomprises?\b", r"\bembryonic\b", r"\bossification\b", r"\bcell types?\b", r"\bmesenchymal\b", r"\bmyocytes?\b", r"\bchondrocytes?\b"]),
    ("management_step", [r"\btreatment\b", r"\bmanage(?:d|ment)?\b", r"\btherapy\b", r"\bfirst-line\b", r"\bprophylaxis\b", r"\bprescri"]),
    ("epidemiology_concept", [r"\bprevalence\b", r"\bincidence\b", r"\bmortality\b", r"\brisk factor\b"]),
    ("diagnostic_criteria", [r"\bdiagnostic criteria\b", r"\bclassification criteria\b", r"\bstaging\b", r"\bdefined as\b"]),
    ("clinical_feature", [r"\bsymptom\b", r"\bsign\b", r"\bpresent"]),
]
EPI_STATISTIC = r"(?i)\b\d+(?:\.\d+)?\s*(?:%|per\s*(?:1000|10\s*000|100\s*000|million))\b|\bprevalence\b|\bincidence\b"
CLINICAL_CUE = r"(?i)\bpresent(?:s|ation|ing)?\b|\bsymptoms?\b|\bsigns?\b|\bexamination\b|\bpain\b|\btender"
BACKMATTER_TOPIC = r"(?i)^(?:Further information|Journal articles|Websites|Patient organisations)$"
COMPLETENESS = {
    "pathophysiology": ["pathophysiology", "aetiology", "cause", "mechanism", "pathogenesis", "genetics"],
    "clinical_features": ["clinical_feature", "symptom", "sign", "presentation", "examination", "history"],
    "investigations": ["laboratory_investigation", "diagnostic_criteria", "investigation", "biomarker", "ecg", "imaging"],
    "management": ["management_step", "drug_info", "treatment", "therapy", "surgery", "dosing"],
    "safety_prognosis": ["complication", "prognosis", "safety", "monitoring", "adverse", "risk"],
}
GENERIC_DISEASES = ["general", "self_assessment", "overview"]
ALGORITHM_TYPES = ["decision_tree", "scoring_system", "stepwise_escalation"]
STAGE_ORDER = ["1", "2", "3", "4a", "4b", "4.5", "4.5c", "4.5d", "4.5b", "4.6", "4.7", "5.2", "5.3", "5.4", "5", "6", "7", "8"]

# --- index
TRIAL = r"(?i)\b([A-Z0-9\-]{2,15})\s*\(([^)]+)\)\s*(?:trial|study|investigation|registry)"
ACRONYM = r"([A-Za-z0-9\s\-]+)\s*\(([A-Z0-9\-]{2,10})\)"
PAGE_JAVA = r"(?<![A-Za-z0-9])(?:(\d+)(?:–|-)(\d+)|(\d+)([tfc]?))(?![A-Za-z0-9])"
SEE = r"\bSee (?:also )?([A-Za-z0-9\s,\-]+)"
SUB_STARTS = ["in ", "of ", "for ", "with ", "as ", "and ", "vs."]

# --- guard
MOJIBAKE = {"â‰¥": ">=", "â‰¤": "<=", "Â±": "+/-", "Âµg": "mcg", "Âµ": "µ", "â€™": "'", "â€˜": "'", "â€œ": '"', "â€\x9d": '"', "â€”": " - ", "â€“": " - ", "Â°C": " deg C", "â†’": "->", "Ã—": "x", "Ã©": "e", "Ã¨": "e"}
SOURCE_MOJIBAKE = {"â‰¥": "≥", "â‰¤": "≤", "Â±": "±", "Âµ": "µ", "Â°": "°", "â€™": "’", "â€˜": "‘", "â€œ": "“", "â€\x9d": "”", "â€”": "—", "â€“": "–", "â†’": "→", "Ã—": "×", "Ã©": "é", "Ã¨": "è"}
LIGATURES = {"ﬀ": "ff", "ﬁ": "fi", "ﬂ": "fl", "ﬃ": "ffi", "ﬄ": "ffl", "ﬅ": "ft", "ﬆ": "st"}
INVISIBLE = "​﻿­‎‏"
CORRUPTION = [r"â‰[¥¤]", r"Â[±µ°]", r"â[€™€˜]", r"â€[“”—–]", r"Ã[—©]", "�", "​", "﻿", "­", r"mcg\s*(?:mol|g)\b", r"\b10(?:9|12)/L\b", "⁄"]
DOSE_REWRITES_JAVA = [
    (r"\b(\d+)\.0+\s*(mg|mcg|g|mL|units)\b(?!\s*/\s*(?:d?L|mL|mmol|h|hr|min)\b)", "$1 $2"),
    (r"(^|[\s(])\.(\d+)\s*(mg|mcg|g|mL|units|mmol)\b", "$10.$2 $3"),
    (r"\b(?:Q\.D\.|QD)\b", "once daily"),
    (r"\b(?:Q\.O\.D\.|QOD)\b", "every other day"),
    (r"(\d+)\s*(?:IU|I\.U\.)\b", "$1 units"),
    (r"(\d+)\s*U\b(?!\s*/\s*[a-zA-Z])", "$1 units"),
]

# --- grounding
EXEMPT_HEADINGS = ["COVERAGE DECLARATION", "VISUAL ASSET", "LAYER 0", "PHYSIOLOGY FOUNDATION", "CLINICAL EVIDENCE", "EVIDENCE NOTES"]
ANCHORED_HEADINGS = ["LAYER 1", "PRE-TRAINING", "LAYER 2", "QB AWARENESS", "EXAM TRAP", "LAYER 3", "PHARMACOLOGY", "LAYER 4", "LAYER 5", "ACTIVE RECALL", "QUICK REVISION"]

# --- modalities and rules
TIER3_WORDS = ["aldosteronism", "gra", "liddle", "channelopathy", "dmpk", "anticipation", "multiple myeloma", "aflp", "ttp", "hus", "linezolid", "adamts13", "cyp11b1", "chimeric"]
TIER1_WORDS = ["fluid", "drop", "dengue", "hypothyroidism", "anemia", "mentzer", "iron", "malaria", "vomiting", "diarrhea", "iv", "cbc"]
# Rule, severity, pattern, jurisdiction.
SLIDE_RULES_JAVA = [
    ("MED-U", "ERROR", r"(?<![A-Za-z])(\d+\s*)U(?![A-Za-z])", "us-origin/global-practice"),
    ("MED-IU", "ERROR", r"(?<![A-Za-z])IU(?![A-Za-z])", "us-origin/global-practice"),
    ("MED-QD", "ERROR", r"(?<![A-Za-z])(q\.?\s?d|Q\.?D|q\.?o\.?d|Q\.?O\.?D|qod|QOD)(?![A-Za-z])", "us-origin/global-practice"),
    ("MED-MS", "ERROR", r"(?<![A-Za-z])(MS|MSO4|MgSO4)(?![A-Za-z0-9])", "us-origin/global-practice"),
    ("MED-MCG", "ERROR", r"[µμ]g", "us-origin/global-practice"),
    ("MED-TRAILZERO", "ERROR", r"\b\d+\.0+\s*(?=(mg|mcg|g|kg|mL|ml|L|units?|unit)\b)", "us-origin/global-practice"),
    ("MED-NAKEDDEC", "ERROR", r"(?<![\d.])\.\d+\s*(mg|mcg|g|kg|mL|ml|L|units?)\b", "us-origin/global-practice"),
    ("MED-CC", "WARN", r"(?<![A-Za-z])cc(?![A-Za-z])", "us-origin/global-practice"),
    ("MED-AT", "ADVISORY", r"@\s*\d", "us-origin/global-practice"),
    ("MED-EYEEAR", "WARN", r"(?<![A-Za-z])(AD|AS|AU|OD|OS|OU)(?![A-Za-z])", "us-origin/global-practice"),
    ("MED-NOSPACE", "ADVISORY", r"\b\d+(mg|mcg|g|kg|mL|ml|units?)\b", "us-origin/global-practice"),
    ("EV-ABSOLUTE", "ERROR", r"(?i)\b(always|never|all patients|in every (?:case|patient)|contraindicated in all|invariably|100% of patients)\b", "us (accredited CME)"),
    ("EV-RECNOSRC", "WARN", r"(?i)\b(first[- ]line|second[- ]line|drug of choice|treatment of choice|recommended|should (?:be )?(?:give|given|start|started|receive|offered)|gold standard)\b", "us (accredited CME)"),
    ("EV-RRONLY", "ADVISORY", r"(?i)\b(\d{1,3}(?:\.\d+)?\s*%\s*(?:relative\s+)?(?:risk\s+)?reduction|\bRRR\b|reduced .{0,20}\bby\s+\d{1,3}\s*%)", "none"),
    ("EV-SIGNIF", "ADVISORY", r"(?i)\b(?:statistically\s+)?significant(?:ly)?\b", "none"),
    ("EV-EMERGING", "WARN", r"(?i)\b(novel|emerging|promising|cutting[- ]edge|breakthrough|paradigm[- ]shift(?:ing)?|game[- ]chang(?:er|ing))\b", "us (accredited CME)"),
    ("JUR-FDA", "WARN", r"(?i)\b(FDA[- ]approved|FDA approval|not FDA[- ]approved|EMA[- ]approved|MHRA[- ]approved)\b", "all"),
    ("JUR-OFFLABEL", "WARN", r"(?i)\boff[- ]label\b|\bunlicensed\b|\bunapproved use\b|\binvestigational\b", "all"),
    ("PHI-AGE90", "ERROR", r"(?i)\b(9[0-9]|1[0-9]{2})[- ]?(?:year|yr)s?[- ]?old\b|\baged?\s+(9[0-9]|1[0-9]{2})\b", "us"),
    ("PHI-DATE", "WARN", r"\b(0?[1-9]|1[0-2])[/-](0?[1-9]|[12][0-9]|3[01])[/-](19|20)\d{2}\b", "us"),
    ("PHI-MRN", "ERROR", r"(?i)\b(MRN|medical record (?:no|number)|hospital (?:no|number)|NHS number)\b[:\s#]*[\w-]{4,}", "us"),
    ("PHI-INITIALS", "ADVISORY", r"\bpatient\s+(?:[A-Z]\.?\s?[A-Z]\.?|[A-Z]{2,3})\b", "us + journal norms"),
    ("CME-TRADENAME", "ERROR", r"\b(?:®|™)", "us + eu (accredited)"),
]
CITATION_MARKER = r"(?i)(\b(19|20)\d{2}\b|\bet al\b|10\.\d{4,9}/|\bdoi\b|\bPMID\b|\[\d+\]|\bNEJM\b|\bJAMA\b|\bLancet\b|\bBMJ\b|\bCochrane\b)"
PRECISION_MARKER = r"(?i)(p\s*[<=>]|\bCI\b|95%|\bHR\b|\bOR\b|\bRR\b)"
ROLE_WEIGHTS = {"divider": 0.35, "title": 0.45, "reference": 0.45, "takeaway": 0.8, "mechanism": 1.0, "evidence": 1.25, "safety": 1.30, "dosing": 1.30, "counselling": 1.25, "case": 1.45, "general": 1.0}
DENSITY_WEIGHTS = {"low": 0.8, "medium": 1.0, "high": 1.25}
DECISIONS = ["confirmed_corruption", "false_positive", "legitimate_paraphrase"]

# Mathematical markup and what stands for it, in the order of application. Exponents and delimiters come between the parts.
LATEX_REFERENCES_JAVA = [
    (r"\\\(\s*\^\{([0-9,\-\s]+)\}\s*\\\)", "[$1]"),
    (r"\$\^\{([0-9,\-\s]+)\}\$", "[$1]"),
    (r"\$\^([0-9]+)\$", "[$1]"),
    (r"\$\^\{([^}]+)\}\$", "[$1]"),
]
LATEX_EXPONENTS_JAVA = [r"(\d)\s*\^\s*\{\s*(-?\d{1,3})\s*\}", r"(\d)\^(-?\d{1,3})(?!\d)"]
LATEX_SYMBOLS_JAVA = [
    (r"\\text\{---\}", " - "),
    (r"\\text\{--\}", "-"),
    (r"\\?[\(\$]\s*S_([1-4])\s*\\?[\)\$]", "S$1"),
    (r"\\?[\(\$]\s*A_2\s*\\?[\)\$]", "A2"),
    (r"\\?[\(\$]\s*P_2\s*\\?[\)\$]", "P2"),
    (r"\\?[\(\$]\s*V_([1-6])\s*\\?[\)\$]", "V$1"),
    (r"\\?[\(\$]\s*A_2\s*(?:-|\\text\{--\}|\s*-\s*)\s*OS\s*\\?[\)\$]", "A2-OS"),
    (r"\\mathrm\{([^}]+)\}", "$1"),
    (r"\\text\{([^}]+)\}", "$1"),
    (r"\\(?:ge|geq)(?=[^a-zA-Z]|$)", ">="),
    (r"\\(?:le|leq)(?=[^a-zA-Z]|$)", "<="),
    (r"\\pm(?=[^a-zA-Z]|$)", "+/-"),
    (r"\\times(?=[^a-zA-Z]|$)", "x"),
    (r"\\cdot(?=[^a-zA-Z]|$)", " * "),
    (r"\\approx(?=[^a-zA-Z]|$)", "~"),
    (r"\\Delta\s*P\b", "Delta P"),
    (r"\\Delta(?=[^a-zA-Z]|$)", "Delta"),
    (r"\\rho(?=[^a-zA-Z]|$)", "rho"),
    (r"\\rightarrow(?=[^a-zA-Z]|$)", "->"),
    (r"\\?[\(\$]\s*\\mu\s*(?:\\(?:text|mathrm)\{g\}|g)\s*\\?[\)\$]", "mcg"),
    (r"\\?[\(\$]\s*\\mu\s*\\?[\)\$]\s*(?:\\(?:text|mathrm)\{g\}|g)\b", "mcg"),
    (r"\\mu\s*(?:\\(?:text|mathrm)\{g\}|g)\b", "mcg"),
    (r"\\?[\(\$]\s*\\mu\s*\\?[\)\$]", "µ"),
    (r"\\mu(?=[^a-zA-Z]|$)", "µ"),
    (r"\\?[\(\$]\s*\\beta\s*([0-9]*)\s*\\?[\)\$]", "beta$1"),
    (r"\\?[\(\$]\s*\\alpha\s*([0-9]*)\s*\\?[\)\$]", "alpha$1"),
    (r"\\%", "%"),
    (r"\b([A-Za-z]{1,4})_\{([0-9A-Za-z]+)\}", "$1$2"),
    (r"V_\{?max\}?", "Vmax"),
    (r"\\?[\(\$]\s*dp/dt\s*\\?[\)\$]", "dp/dt"),
]
LATEX_KEPT_JAVA = r"(?i:\b(?:to|and|or|per|with|between|from)\b)|\\(?:frac|sqrt|sum|int|partial|mathbf|begin|end)"
LATEX_SUBSCRIPTS_JAVA = [
    (r"\b([A-Za-z]{1,4})_\{([0-9A-Za-z]+)\}\b", "$1$2"),
    (r"\b([A-Za-z]{1,4})_([0-9]+)\b", "$1$2"),
    (r"(>=|<=|>|<)([0-9])", "$1 $2"),
]
MICROGRAM_JAVA = [(r"([0-9\.\s])[µμ]g\b", "$1mcg"), (r"\b[µμ]g\b", "mcg"), (r"([0-9\.\s])ug\b", "$1mcg"), (r"\bug\b", "mcg")]
PLAIN_SIGNS = {"≥": ">=", "≤": "<=", "±": "+/-", "°C": " deg C", "—": " - ", "–": " - ", "’": "'", "‘": "'", "“": '"', "”": '"'}
SAFETY_DRUGS = ["sacubitril", "spironolactone", "aspirin", "metformin", "amiodarone", "digoxin", "apixaban", "warfarin", "furosemide"]
SAFETY_INDICATION, SAFETY_PRECAUTIONS = "Cardiovascular pharmacotherapy", "Monitor renal function, electrolytes, and hemodynamics."
SEMVER = r"^v?((?:0|[1-9]\d*)\.(?:0|[1-9]\d*)\.(?:0|[1-9]\d*)(?:-[0-9A-Za-z-]+(?:\.[0-9A-Za-z-]+)*)?(?:\+[0-9A-Za-z-]+(?:\.[0-9A-Za-z-]+)*)?)$"

# What the scan of a setup folder passes over, and what marks a control file.
EXCLUDED_FOLDERS = [".git", ".hg", ".svn", ".next", ".pytest_cache", ".ruff_cache", ".tox", ".venv", "__pycache__", "build", "cache", "coverage", "dist", "node_modules", "vendor", "venv"]
SECRET_FOLDERS = [".aws", ".gnupg", ".ssh", "credentials", "keychain", "secrets"]
SECRET_FILES = [".env", "cookies", "cookies.sqlite", "credentials.json", "id_dsa", "id_ed25519", "id_rsa", "login data", "secrets.json"]
SECRET_STARTS = [".env.", "credentials.", "secrets."]
SECRET_SUFFIXES = [".key", ".p12", ".pfx", ".pem"]
CONTROL_FILES = [".cursorrules", ".mcp.json", "agents.md", "claude.md", "gemini.md", "skill.md", "config.toml", "mcp.json", "openai.yaml", "settings.json", "settings.local.json"]
CONTROL_FOLDERS = [".agents", ".claude", ".codex", ".cursor", "agents", "checks", "guardrails", "hooks", "instructions", "memory", "prompts", "references", "rules", "skills", "validators"]
CONTROL_WORDS = ["agent", "approval", "config", "guardrail", "hook", "instruction", "memory", "permission", "prompt", "rule", "schema", "setting", "skill", "tool", "validator"]
CHECK_FOLDERS = ["checks", "guardrails", "hooks", "validators"]
INSTRUCTION_FILES = ["agents.md", "claude.md", "gemini.md"]
TEXT_SUFFIXES = [".json", ".md", ".mdx", ".prompt", ".rules", ".toml", ".txt", ".yaml", ".yml"]
DOCUMENT_SUFFIXES = [".docx", ".pdf", ".pptx", ".rtf", ".xlsx"]
SCRIPT_SUFFIXES = [".js", ".py", ".sh", ".ts"]

# The stations of a setup map, and what in a path puts a control there.
STATIONS = ["already-there", "chooses-help", "joins-job", "can-do", "proves-done"]
PROOF_MARKS = ["validator", "guardrail", "hook", "receipt", "test", "check"]
POWER_MARKS = ["permission", "approval", "tool", "mcp", "sandbox", "authority"]
ROUTE_MARKS = ["catalog", "router", "trigger"]

# Run traces and reviews.
TRACE_STATUSES = ["COMPLETE", "PARTIAL", "NOT_EXPOSED"]
RUN_STAGES = ["Available", "Eligible", "Shown", "Consulted", "Acted through", "Checked", "Accepted"]
STAGE_STATUSES = ["VERIFIED", "INFERRED", "INACCESSIBLE", "NOT_EXPOSED", "UNKNOWN"]
REVIEW_DECISIONS = ["KEEP", "ONE_HOME", "LOAD_LATER", "MAKE_A_CHECK", "PROBATION", "RETIRE"]
EVIDENCE_STATES = ["VERIFIED", "USER_REPORTED", "INFERRED", "INACCESSIBLE", "NOT_APPLICABLE"]
REVIEW_LIMITS = {"QUICK_CHECK": 50, "MAINTAINER_AUDIT": 500}
DECISION_TEXTS = {"reader_name": 160, "current_effect": 500, "proposed_change": 1000, "reason": 1000, "must_survive": 500, "risk_if_wrong": 500, "rollback": 500}
MOST_UNREVIEWED = 5000

# Guidance named with a year, and what an accredited deck has to state (rule, severity, pattern).
DATED_GUIDANCE = r"(?i)\b(guideline|guidance|recommendation|consensus|position statement)\b[^.]{0,80}?\b(19|20)(\d{2})\b"
DECK_STATEMENTS = [
    ("CME-MISSING-ACCREDITATION-STATEMENT", "ERROR", r"(?i)is accredited by the Accreditation Council"),
    ("CME-MISSING-CREDIT-DESIGNATION", "ERROR", r"(?i)AMA PRA Category 1 Credit"),
    ("CME-MISSING-DISCLOSURE", "ERROR", r"(?i)\b(disclosure|financial relationship|conflict of interest)\b"),
    ("CME-MISSING-MITIGATION-STATEMENT", "WARN", r"(?i)relevant financial relationships have been mitigated"),
]
