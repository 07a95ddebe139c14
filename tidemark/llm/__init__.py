"""Training-data operators: search, filters, near-duplicates, mixing, tokens. Nothing else imports this."""
