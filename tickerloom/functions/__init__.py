"""Part of the tickerloom library."""
