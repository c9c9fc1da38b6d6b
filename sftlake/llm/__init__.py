"""Training-data operators: quality, packing, extraction, near duplicates, decontamination,
language, url filters. Nothing else in the package imports from here."""
