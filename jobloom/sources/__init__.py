"""Where postings, pages, rules and dictionaries come from."""
