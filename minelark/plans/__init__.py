"""Plan shapes shared by the operators: skew-safe pairing and lineage cuts."""
