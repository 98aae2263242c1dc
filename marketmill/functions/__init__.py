from marketmill.functions.columns import (  # noqa: F401
    BUCKET_LABELS,
    average_of_sums,
    bucket_order,
    day_gap,
    fits_minor,
    from_minor,
    lateness_bucket,
    minor_units,
    money_sum,
    month_label,
    month_start,
    percent,
    quotient_sums,
    round_half,
    stable_average,
)
