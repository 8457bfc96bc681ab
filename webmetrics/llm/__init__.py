"""Training-data operators: dedup, decontamination, quality, language, WARC, mixing."""
