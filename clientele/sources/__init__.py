"""Transaction schema, loaders and sinks."""

from clientele.sources.schema import TRANSACTION_SCHEMA, TRANSACTION_COLUMNS  # noqa: F401
from clientele.sources.transactions import (  # noqa: F401
    clean_transactions,
    read_transactions_csv,
    read_transactions_parquet,
    transactions_from_tables,
)
