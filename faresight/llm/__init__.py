"""Training-data operators: search, packing, language, quality, duplicates, secrets, tokens, language model, chat."""
