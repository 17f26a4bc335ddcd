"""DataFrame in, DataFrame out: building layers, profiling, evidence, reconciliation, mutations."""
