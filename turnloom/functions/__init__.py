"""Column functions: text clean-up, tokens and single-message rules."""
