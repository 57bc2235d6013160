from strata.functions.scalar import (  # noqa: F401
    bucket, bytes_to_mb, clean_code, clean_text, format_amount, is_positive,
    normalise_path, ratio, relative_to, to_date, to_double, to_float, to_int,
    year_of, years_between,
)
