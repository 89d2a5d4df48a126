"""Fixed values of the data contract that column expressions need: exactly these are right."""

# The day format raw files use.
ISO_DAY = "yyyy-MM-dd"

# Quality flags: the label of a row without one, and what joins several.
CLEAN = "clean"
FLAG_SEPARATOR = "&"

# The status of an order that counts.
COMPLETED = "completed"
