"""Fixed values.

The values in this block must equal the reference's for identical results:
category codes, the symptom column list, label name, decision threshold,
risk-tier bounds, display precision and split shares. Tier names and
conclusion texts are our English display values.
"""

# --- fixed values (reference parity) -------------------------------------
GENDER_CODE = {"Male": 1, "Female": 0}
YES_NO_CODE = {"Yes": 1, "No": 0}
CLASS_CODE = {"Positive": 1, "Negative": 0}
SYMPTOM_COLUMNS = (
    "Polyuria", "Polydipsia", "sudden weight loss", "weakness",
    "Polyphagia", "Genital thrush", "visual blurring", "Itching",
    "Irritability", "delayed healing", "partial paresis",
    "muscle stiffness", "Alopecia", "Obesity",
)
NUMERIC_COLUMNS = ("Age",)
LABEL_COLUMN = "class"
DECISION_THRESHOLD = 0.5
# half-open [lo, hi) bounds; anything else (1.0, null) is undetermined
RISK_TIERS = (
    (0.0, 0.2, "low"),
    (0.2, 0.5, "medium"),
    (0.5, 0.7, "elevated"),
    (0.7, 1.0, "high"),
)
DISPLAY_DECIMALS = 4
SPLIT_PERCENT = (70, 15, 15)
SPLIT_SEED = 42
HISTOGRAM_BAR_SLOTS = 30
PREVIEW_DEFAULT_ROWS = 10
# --- end of fixed values --------------------------------------------------

UNDETERMINED = "undetermined"
CONCLUSION_POSITIVE = "positive (at risk)"
CONCLUSION_NEGATIVE = "negative (no risk found)"
SPLIT_NAMES = ("train", "val", "test")

# name of the assembled feature vector inside a pipeline
FEATURES_VEC = "features"
