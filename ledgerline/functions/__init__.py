"""Column functions: one text cell in, one typed cell out."""

from ledgerline.functions.cells import (
    cell,
    lenient_decimal,
    lenient_epoch,
    lenient_int,
    number_cell,
    point,
    strict_epoch,
    strict_number,
    strict_point,
    strict_text,
    violation,
)

__all__ = [
    "cell",
    "lenient_decimal",
    "lenient_epoch",
    "lenient_int",
    "number_cell",
    "point",
    "strict_epoch",
    "strict_number",
    "strict_point",
    "strict_text",
    "violation",
]
