"""Training-data operators: sharding, filtering, scanning, formatting, dedup, mixing."""
