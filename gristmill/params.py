"""Constants of the extraction engine; every operator takes them as parameters."""

from __future__ import annotations

#: Significance, effect sizes and group sizes of the missingness tests.
ALPHA, MEAN_GAP_FACTOR, HIGH_NULL_RATE, LOW_NULL_RATE, MIN_GROUP, ID_RATIO = 0.05, 0.5, 0.9, 0.1, 5, 0.5
#: Similarity from which a new column is a renamed one; wrong characters that a key may have.
RENAME_CUTOFF, KEY_DISTANCE = 0.75, 1
#: Confidence of each way a value was obtained.
CONFIDENCE = {"direct": 1.0, "imputed": 0.9, "backfilled": 0.8, "human_review": 0.0}
RULE_TRUE, RULE_FALSE, THRESHOLD = 0.95, 0.7, 0.85
#: Classes known beforehand.
PRIORS = {"compliance_flag": "MNAR"}
KEY, TIME, SOURCE = "entity_key", "updated_at", "source_system"
#: Cells of text files that are null.
NULL_TOKENS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")
#: Vocabulary of the lexical gate, section headings, terms of the indemnification rule, hedge words.
TRIGGERS = ("indemnify", "indemnification", "hold harmless", "liability", "liable", "limitation of liability", "damages")
HEADINGS = ("recitals", "indemnification", "limitation of liability", "affiliates and subcontractors", "term and termination", "governing law")
INDEMNITY_TERMS = ("indemnify", "indemnification", "hold harmless")
INDEMNITY_SECTIONS, LIABILITY_SECTIONS = ("indemnification", "recitals", "unstructured"), ("limitation_of_liability", "unstructured")
HEDGES = ("may", "possibly", "unclear", "subject to further negotiation", "to be determined", "tbd")
#: Patterns of personal details, in the order in which they are replaced.
REDACTIONS = (
    ("SSN", r"(?U)\b\d{3}-\d{2}-\d{4}\b"), ("PHONE", r"(?U)\b\(?\d{3}\)?[-.\s]\d{3}[-.\s]\d{4}\b"), ("EIN", r"(?iU)\bEIN[:\s]*\d{2}-\d{7}\b"), ("EMAIL", r"(?U)\b[\w.+-]+@[\w-]+\.[\w.-]+\b"),
)


def setting(spark, name: str, default):
    """A parameter of this engine from the session: `spark.gristmill.<name>` in the type of its default."""
    given = spark.conf.get(f"spark.gristmill.{name}", None)
    if given is None:
        return default
    return given.lower() in {"true", "1", "yes"} if isinstance(default, bool) else type(default)(given)
