"""Column expressions (Catalyst, codegen'd); no per-row Python."""
