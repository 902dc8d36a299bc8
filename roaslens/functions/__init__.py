from roaslens.functions.exprs import (  # noqa: F401
    safe_ratio, pct_change, log_ratio, log_mean, to_float, direct_contribution_pct,
    fmt_money, fmt_money_signed, fmt_pct, fmt_pct_yoy, fmt_roas, fmt_pp, fmt_driver_metric,
    trend, path_key, trace_text, paths_text, trace_node_for_dim, last_node, channel_type,
    yoy_polarity, clean_number, dsum,
)
