"""Operators on event rows: filters (F1-F5), metrics as aggregation levels
(A3-A7, X2), sessions by gap (X1, P4), totals (A8-A10), calendar completion (V4)."""
