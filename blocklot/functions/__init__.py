"""Column-expression functions: key standardisers and date-to-year rules."""

from .keys import (census_tract, community_board, council_district, int_key,  # noqa: F401
                   int_key_text, joined_values, school_district, spare_capacity,
                   STANDARDISERS, truncated_int, zero_pad, fill_zero)
from .dates import any_year, strict_year  # noqa: F401
