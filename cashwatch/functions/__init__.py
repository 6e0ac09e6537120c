"""Column expressions: amounts, ratios, flags, time buckets and stable keys."""
