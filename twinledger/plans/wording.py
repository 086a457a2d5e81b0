"""Sentences of the report, in one place: the rules and the checks of the queries read them from here."""

# Why a tier was not run.
NO_KEYS = "the view has no key columns"
KEYS_UNUSABLE = "the key columns do not identify rows well enough to match them"
TOLERATED = "an earlier tier tolerates differences, so unequal fingerprints are expected"
DIFFERS = "an earlier tier already shows differences"
NO_COMMON_KEYS = "neither extract has a key of the other"

# Why a column that differs is accepted or not: base reason, then what its rule covers.
LISTED = "listed as accepted"
COVERS, OF, TOLERABLE, OPEN = " (rule covers ", " of ", "; the rest is within tolerance)", "; the rest is open)"

# What became of a tier with a configured acceptance.
ACCEPTED_BY_CONFIG = "accepted by configuration"
TOLERATED_ANYWAY = "within tolerance even without its configured acceptance"

HEADERS_DIFFER = "Content is compared once both sides have the same columns."
FIRST_ROWS_ONLY = "Keys repeat: of each key the first row on each side is compared."
