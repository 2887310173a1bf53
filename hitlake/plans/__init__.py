"""The lake, the ledger and the daily load."""
