"""Where records, audits, issues, rules and raw inputs are written."""
