"""Query catalog (operator on adapter input + its independent SQL form) and the end-to-end preparation plan."""
