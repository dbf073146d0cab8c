"""End-to-end compositions of the operators (the reference's two programs)."""
