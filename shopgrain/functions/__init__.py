from shopgrain.functions.columns import (  # noqa: F401
    as_money,
    email_mask,
    money_sum,
    ratio,
    rounded,
    surrogate_key,
    to_bool,
    to_day,
)
