"""Writing raw and typed layers."""
