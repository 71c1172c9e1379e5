from farsight.streaming.source import item_stream, item_text_stream, table_stream  # noqa: F401
from farsight.streaming.items import ItemStream, ItemStreamFailed, arrivals  # noqa: F401
