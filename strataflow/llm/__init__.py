"""Training-data operators: toxicity, repeated passages, decontamination, personal data, vector search,
chat formatting, near duplicates, language identification, packing and sharding."""
