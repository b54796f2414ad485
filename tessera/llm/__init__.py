"""Training-data operators: packing, classification, deduplication, extraction and archives."""
