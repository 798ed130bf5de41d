"""Spark expressions that carry the missing-value and ordering rules of the source scripts."""

from visitline.functions.semantics import (
    cut_rank,
    cut_right,
    day_number,
    day_to_date,
    first_by,
    join_on_keys,
    joined_list,
    keep_group_extreme,
    n_distinct_na,
    n_rows,
    nulls_last_key,
    own_shuffle,
    poisoned,
    r_cut_labels,
    r_number_text,
    r_text_na,
    several_rows,
    sort_keys,
)

__all__ = [
    "cut_rank",
    "cut_right",
    "day_number",
    "day_to_date",
    "first_by",
    "join_on_keys",
    "joined_list",
    "keep_group_extreme",
    "n_distinct_na",
    "n_rows",
    "nulls_last_key",
    "own_shuffle",
    "poisoned",
    "r_cut_labels",
    "r_number_text",
    "r_text_na",
    "several_rows",
    "sort_keys",
]
