"""Key columns and fixed values shared by the operators."""

from __future__ import annotations

SCOPE = ["app_id", "user_id"]

# Results depend on these exact lists, names and numbers.
TEXT_FIELDS = ["title", "content", "notes", "body", "comment", "text", "description"]
KEYWORD_FIELDS = ["keywords", "labels", "categories", "ingredients", "tags_source"]
METADATA_KEYWORD_FIELDS = ["keywords", "categories", "ingredients"]
ID_FIELDS = ["id", "source", "source_ref", "url", "title"]
STOP_WORDS = (
    "about after again also and are but can for from had has have her his into its more "
    "not our out over she that the their then there this was were with you your"
).split()
CATALYST_PROFILES = [
    "preference_evidence",
    "tension_trace",
    "resonance_trace",
    "relational",
    "operational",
    "decision_trace",
    "reflective",
]
DEFAULT_ID_PREFIX = "auto-cluster"
DEFAULT_THRESHOLD = 0.60
DEFAULT_K = 8
DEFAULT_MIN_CLUSTER_SIZE = 5
DEFAULT_RESOLUTION = 0.35
DEFAULT_SEED = 13
# (resolution, similarity threshold) settings tried by the sweep.
SWEEP = {
    "balanced": [(0.25, 0.62), (0.35, 0.60), (0.45, 0.58), (0.60, 0.56), (0.80, 0.54), (1.00, 0.52)],
    "fine": [(0.45, 0.60), (0.60, 0.58), (0.80, 0.56), (1.00, 0.54), (1.20, 0.52), (1.40, 0.50)],
}
SMALL_SCOPE_SETTING = (1.20, 0.45)
SMALL_SCOPE_LIMIT = 50
