"""Training-data operators: scoring, search, packing, mixing and duplicate removal over document tables."""
