from ledgerscope.streaming.monitor import (daily_alert_counts, read_transfer_stream,
                                           row_rule_flags, sender_gap_state, run_to_table)

__all__ = ["daily_alert_counts", "read_transfer_stream", "row_rule_flags", "sender_gap_state",
           "run_to_table"]
