from tallyhouse.operators.dedup import one_row_per_key, variants
from tallyhouse.operators.numbering import number_rows, rank_rows
from tallyhouse.operators.scratch import (
    in_parts, release, released, scratch_folder, shuffles_removed, stage, together,
)

__all__ = [
    "in_parts",
    "number_rows",
    "one_row_per_key",
    "rank_rows",
    "release",
    "released",
    "scratch_folder",
    "shuffles_removed",
    "stage",
    "together",
    "variants",
]
