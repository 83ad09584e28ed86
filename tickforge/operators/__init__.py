"""DataFrame -> DataFrame steps: derive, landing, pairs, holidays, quality."""
