"""Column functions: month/year codes and names, percent rounding (P1-P9),
number formats and display helpers (T1-T7), report headings (P8)."""
