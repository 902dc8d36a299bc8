from roaslens.plans.pipeline import Analysis, Report, analyze, build_report, run_report  # noqa: F401
