"""Sources (CSV ingest modes, driver-table adapters) and sinks."""

from .csv import (read_transactions_checked, read_transactions_csv, read_transactions_strict,  # noqa: F401
                  read_transactions_upload)
from .sinks import publish_scored, read_published, write_nested, write_scored  # noqa: F401
from .tables import (employees_from_supplier, payroll_from_lineitem,  # noqa: F401
                     transactions_from_events)
