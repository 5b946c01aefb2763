"""Constants (bins, dimensions) and column expressions."""
