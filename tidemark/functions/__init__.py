"""Column functions: names, audit columns, payloads, text and times."""
