"""Operators for preparing training text: filters, near duplicates, privacy, packing, tokens, languages, pages."""
