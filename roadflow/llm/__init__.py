"""Training-data operators: near duplicates, search, classification, mixing, tokenisation and output."""
