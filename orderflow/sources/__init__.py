"""Sources and sinks: driver tables, message logs, ledger, acks, JSON logs."""
