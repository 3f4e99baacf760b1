"""Query library over the five canonical tables (``tables``), the analytics
queries (``queries``) and their DuckDB oracle statements (``oracle``)."""
