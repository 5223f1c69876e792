"""Business plans: extracts, reconciliation, cycles, campaigns, feeds."""
