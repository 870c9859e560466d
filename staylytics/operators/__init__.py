"""Analysis operators over the gold tables; each returns a DataFrame."""
