"""Training-data operators: mixing, language, near copies, packing, chat records, binary records, quality."""
