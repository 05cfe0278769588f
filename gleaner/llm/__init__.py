"""Training-data operators: quality, chat, URL, dedup, PII, mixing, scoring,
licence and decontamination jobs. Nothing else in the library imports this
subpackage."""
