"""Column expressions: null-safe casts, derivations, bands, rounding."""
