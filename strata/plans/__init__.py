"""Layer transforms: landing, core, marts (lazy DataFrame in, DataFrame out)."""
