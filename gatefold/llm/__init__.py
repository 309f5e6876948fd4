"""Training-data operators: extraction, cleaning, dedup, scoring, mixing, packing, formatting.

Nothing outside this folder imports it. ``catalog`` holds the registered queries and their SQL.
"""
