"""Column expressions and join helpers."""

from ratesmith.functions.columns import (  # noqa: F401
    STABLECOIN,
    STABLECOIN_FIAT,
    either_side_in,
    normalise_stablecoin,
    pair_in,
    parse_date,
    safe_inverse,
    safe_ratio,
    split_part,
    strip_to_number,
    to_double,
)
from ratesmith.functions.joins import broadcast_if_small, estimated_bytes  # noqa: F401
