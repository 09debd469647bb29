"""Column -> Column scalar expressions (native, codegen-friendly)."""
