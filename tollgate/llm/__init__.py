"""Training-data operators: near-dedup, decontamination, packing, PII, token
counts, URL rules, HTML text, language id, quality rules and LM scoring."""
