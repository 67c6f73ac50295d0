"""almanac — monthly web and app analytics on Spark.

Main entry points:

* ``almanac.plans.spec``        ReportSpec, DateRange, Exact, AnyOf
* ``almanac.plans.report``      run_report (R8) and the ready-made reports
* ``almanac.plans.bundle``      run_bundle: several reports from shared scans
* ``almanac.operators``         filters, metrics, sessions, totals, scaffold
* ``almanac.functions``         month/year codes, names, number formats, headings
* ``almanac.sources``           bindings, property registry, typed rows, sinks
* ``almanac.streaming``         Structured Streaming sessionizer
"""

__version__ = "0.1.0"
