from veil.functions.digest import ALGORITHMS, salted_digest, salted_hash
from veil.functions.scalar import (
    ceil_to,
    concat_present,
    floor_to,
    keyed_between,
    parse_date,
    parse_number,
    random_between,
    register_sql_functions,
    replace_text,
    round_half_up,
    round_significant,
    sha256_concat,
)
from veil.functions.templates import Chain, Step, chain_column

__all__ = [
    "ALGORITHMS",
    "Chain",
    "Step",
    "ceil_to",
    "chain_column",
    "concat_present",
    "floor_to",
    "keyed_between",
    "parse_date",
    "parse_number",
    "random_between",
    "register_sql_functions",
    "replace_text",
    "round_half_up",
    "round_significant",
    "salted_digest",
    "salted_hash",
    "sha256_concat",
]
