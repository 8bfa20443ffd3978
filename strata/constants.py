"""Names and literals shared by every layer."""

# Reserved column names of the layers.
RESCUED = "_rescued_data"
LOADED_AT = "__etl_loaded_at"
SOURCE_UPDATED_AT = "__source_updated_at"
PROCESSED_AT = "__etl_processed_at"
START_AT = "__START_AT"
END_AT = "__END_AT"
EFFECTIVE_FROM = "__etl_effective_from"
EFFECTIVE_TO = "__etl_effective_to"
IS_CURRENT = "__etl_is_current"

# Literals a registry may override in its "settings" section.
START_OF_TIME = "2000-01-01 00:00:00"
END_OF_TIME = "9999-12-31 23:59:59"
NULL_MARKER = "^^"
FIELD_SEPARATOR = "||"
