"""Feature selection, model search and evaluation on MLlib."""
