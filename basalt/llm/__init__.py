"""Training-data operators: near-duplicate search, scoring, tokenizers, chat and mixing."""
