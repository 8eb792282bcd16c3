"""Training-data operators: filters, models, tokenizers and near-duplicate joins over text and embeddings."""
