"""Operations of a training-data pipeline: extraction, filters, deduplication,
mixing, scoring, search, formatting and tokenising. Nothing else in the
library imports this subpackage."""
