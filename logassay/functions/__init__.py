"""Column-level building blocks: clocks, safe arithmetic, exact quantiles."""
