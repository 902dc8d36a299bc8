from roaslens.sources.mapped import mapped_long_table, load_tables  # noqa: F401
from roaslens.sources.ingest import (  # noqa: F401
    build_engine_frame, engine_frame, normalize_long, normalize_wide, mtd_cutoff,
    parse_error_counts, filter_counts, looks_like_supported, normalize_headers,
    standardize_known_columns,
)
