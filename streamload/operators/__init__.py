"""DataFrame -> DataFrame operators of the ingestion pipeline."""

from .audit import (append_audit, audit_rows, batch_offsets, latest_offsets, offsets_map, read_audit,
                    starting_offsets_json)
from .dedup import anti_join_errors, anti_join_existing, dedup_within_batch, existing_keys, restrict_to_keys
from .hooks import (ContractError, apply_flattener, apply_transformer, chain, check_contract, derive_score,
                    mask_columns, threshold_flattener)
from .parse import (ENVELOPE, flatten, flatten_columns, flattener_input, parse_json_records, parse_messages,
                    project_envelope)
from .quality import error_reason, error_summary, reserialized_json, split_bad_records, to_error_rows
from .rules import apply_rules, build_condition, rules_condition

__all__ = [
    "ENVELOPE", "ContractError", "anti_join_errors", "append_audit", "read_audit", "anti_join_existing", "apply_flattener", "apply_rules",
    "apply_transformer", "audit_rows", "batch_offsets", "build_condition", "chain", "check_contract",
    "dedup_within_batch", "derive_score", "error_reason", "error_summary", "existing_keys", "flatten",
    "flatten_columns", "flattener_input", "latest_offsets", "mask_columns", "offsets_map",
    "parse_json_records", "parse_messages", "project_envelope", "reserialized_json", "restrict_to_keys", "rules_condition",
    "split_bad_records", "starting_offsets_json", "threshold_flattener", "to_error_rows",
]
