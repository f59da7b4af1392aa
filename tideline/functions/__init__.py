from tideline.functions.time import (  # noqa: F401
    duration_us, epoch_us, epoch_ms, ntz_from_us, ntz_from_ms, event_time, to_ntz,
)
