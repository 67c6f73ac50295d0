"""Report specifications and their plans: ReportSpec and the filter tree,
the report compiler (R1-R4, R8) and the multi-report bundle (R5, K4, V1-V5)."""
