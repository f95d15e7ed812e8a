from orderwell.functions.scalars import (  # noqa: F401
    date_key,
    money,
    month_diff,
    month_start,
    ratio,
    round_cents,
    sum_money,
    times,
    zero_if_null,
)
