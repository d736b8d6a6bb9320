from feedweave.functions.coerce import (  # noqa: F401
    clamp_int,
    cut,
    lenient_date,
    lenient_float,
    lenient_int,
    null_to_zero,
    round_money,
    strip_pound,
    trim_blanks,
)
from feedweave.functions.keys import availability_rank, match_key, row_key  # noqa: F401
from feedweave.functions.paths import directory, extension, file_name, without_login  # noqa: F401
