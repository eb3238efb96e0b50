from pitlane.functions.scalars import (  # noqa: F401
    between_or_null,
    clamp_unit,
    first_threshold,
    parse_ts,
    ratio_pct,
    rnd,
    rnd_even,
    strip_ws,
    title_case,
)
