"""Patterns that the files' columns must match."""

# The patterns of the two files' columns.
LOCATION_PATTERN = r"^[A-Z][A-Za-z\(\)\'\-\s]+$"
CONTINENT_PATTERN = r"^[A-Za-z,\s]+$"
VARIANT_PATTERN = r"^[A-Za-z\.:_][A-Za-z0-9\.:_]+$"
DATE_PATTERN = r"^[0-3][0-9]\.[01][0-9]\.[12][0-9]{3}$"
