from ledgerscope.sources.schema import ACCT_SCHEMA, TXN_SCHEMA
from ledgerscope.sources.fixtures import accounts_from_tables, transactions_from_events, load_views
from ledgerscope.sources.io import (read_transactions, read_accounts, read_features,
                                    write_table, write_report)

__all__ = ["ACCT_SCHEMA", "TXN_SCHEMA", "accounts_from_tables", "transactions_from_events",
           "load_views", "read_transactions", "read_accounts", "read_features",
           "write_table", "write_report"]
