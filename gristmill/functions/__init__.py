"""Column builders: scalars, text cleaning, matching and structure of texts."""
