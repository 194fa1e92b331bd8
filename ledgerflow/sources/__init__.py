"""Sources: every reader returns a DataFrame."""
