from marketlake.functions.scalars import (
    blank_to_null,
    epoch_ms_to_ts,
    file_name_date,
    instant_to_ntz,
    is_epoch_ms,
    ntz_to_epoch_ms,
    ntz_to_instant,
    path_attributes,
    ratio_change,
    row_key,
    salt,
    to_double,
)

__all__ = [
    "blank_to_null",
    "epoch_ms_to_ts",
    "file_name_date",
    "instant_to_ntz",
    "is_epoch_ms",
    "ntz_to_epoch_ms",
    "ntz_to_instant",
    "path_attributes",
    "ratio_change",
    "row_key",
    "salt",
    "to_double",
]
