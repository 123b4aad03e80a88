"""Sources and sinks: nested block tables, token list, fixture ledgers, exports."""
