"""Sources: driver tables, text, in-memory rows, replay, Kafka, SQL views."""

from clickflow.sources.tables import table, click_view, clicks, from_click_records  # noqa: F401
from clickflow.sources.text import read_lines, stream_lines, document_lines  # noqa: F401
from clickflow.sources.views import register_view, sql_over  # noqa: F401
