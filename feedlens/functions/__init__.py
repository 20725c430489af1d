"""Column-level and small DataFrame helpers shared by the operators:
time ranges and buckets, md5-based splits and draws, t / normal tails,
IEEE-identical rounding, and the distributed running totals behind every
global rank and exact quantile."""
