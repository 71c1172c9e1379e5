from farsight.sources.tables import (  # noqa: F401
    TABLES, read_table, points2d, points_nd, stream_items, stream_items_timed,
    read_points_text, read_items_text,
)
