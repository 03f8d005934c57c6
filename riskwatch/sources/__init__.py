from riskwatch.sources.payment_events import write_payment_events
from riskwatch.sources.result_log import (
    as_log_rows,
    emit,
    log_field,
    log_fields,
    read_results,
    read_written,
    write_results,
)
from riskwatch.sources.seen import refresh_seen
from riskwatch.sources.tables import COLUMNS, Sources

__all__ = [
    "COLUMNS", "Sources", "as_log_rows", "emit", "log_field", "log_fields", "read_results", "read_written",
    "refresh_seen", "write_payment_events", "write_results",
]
