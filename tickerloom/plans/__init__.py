"""Jobs built from the operators: load, verify, derive factors, serve series."""
