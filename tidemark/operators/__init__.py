"""DataFrame-to-DataFrame operators: decode, check, apply, compare, audit."""
