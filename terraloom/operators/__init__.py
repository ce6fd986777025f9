"""DataFrame to DataFrame operators; identity and order are explicit columns."""
