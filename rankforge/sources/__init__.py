"""Raw schemas, readers/writers, and stand-in raw tables."""

from rankforge.sources.io import (  # noqa: F401
    as_table, as_view, export_csv, land_append, read_all_raw, read_raw,
)
from rankforge.sources.schemas import CATALOGUE, PAGEVIEWS, RANKED_LIST, RAW_TABLES  # noqa: F401
