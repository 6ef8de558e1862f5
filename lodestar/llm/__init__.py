"""Training-data operators: sharding, quality, decontamination, deduplication,
chat formatting, toxicity, packing, HTML rendering and training-order output.

Each module holds one operator with a general interface; ``queries`` binds
them to the driver's tables.  Nothing outside this package imports it.
"""
