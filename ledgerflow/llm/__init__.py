"""Training-data operators: quality, licenses, tokens, personal data, language,
duplicates and packing. Nothing else in the library imports this subpackage."""
