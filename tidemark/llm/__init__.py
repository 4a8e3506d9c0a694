"""Training-data operators (ten operators and their queries).  Nothing outside imports this."""
