"""Settings of the linkage pipeline."""

from __future__ import annotations

from dataclasses import dataclass

#: Columns of a source record, and of the model's features, in order.
RECORD_COLUMNS = ("entity_id", "business_name", "business_address", "country")
FEATURES = (
    "block_score", "exact_hits", "shape_hits", "name_exact", "core_name_exact", "address_exact", "name_jaro", "core_name_jaro", "address_jaro",
    "name_levenshtein", "core_name_levenshtein", "address_levenshtein", "name_char_jaccard", "address_char_jaccard", "name_token_jaccard",
    "address_token_jaccard", "name_token_overlap", "address_token_overlap", "digit_overlap", "digit_jaccard", "name_length_ratio",
    "address_length_ratio", "target_address_missing", "max_field_jaro", "joint_jaro",
)
#: Legal forms that are taken off names, and words that make no signature.
LEGAL_WORDS = "inc incorporated llc llp ltd limited private pvt plc corp corporation company co gmbh sa sas sarl bv ag".split()
NAME_STOP = (
    "and the inc incorporated llc llp ltd limited private pvt plc corp corporation company co gmbh sa sas sarl services service group "
    "enterprises enterprise center centre"
).split()
ADDRESS_STOP = (
    "road rd street st avenue ave lane ln drive dr court ct boulevard blvd floor fl unit suite block near box po india usa united states null"
).split()
#: Weights of the kinds of signatures, and of a composite one.
KIND_WEIGHTS = {"ne": 1.20, "ae": 1.00, "ns": 0.42, "as": 0.32}
PAIR_WEIGHT = 16.0


@dataclass(frozen=True)
class LinkConfig:
    """Bounds of retrieval and the split of the labelled records.

    max_pair_frequency: a pair of words that more targets of a country and source have is refined by third words; a pair with a third
    word that more have is left out, as common words are. None keeps every pair as it is. blank_country: targets without a country are sought
    by the queries of every country; by default only by those without one.
    """

    train_percent: int = 8
    validation_percent: int = 2
    max_token_frequency: int = 96
    max_shape_frequency: int = 24
    max_pair_frequency: int | None = 12
    blank_country: bool = False
    prefilter_candidates: int = 40
    max_candidates_per_source: int = 10
    longest_tokens: int = 12
    trees: int = 420
    depth: int = 7
    learning_rate: float = 0.075
    seed: int = 247
