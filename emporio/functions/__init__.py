"""Column functions: each returns a native ``Column``, so plans stay inside codegen."""
