from lakemart.sources.files import (empty_like, lookup_table, parse_json_rescued,
                                   quarantine_split, read_change_feed, read_json_lines, read_window,
                                   rescued_keys, with_lineage)
from lakemart.sources.schema import (detect_drift, drift_state, evolve_schema, evolve_stored_schema,
                                    infer_json_schema, load_schema, store_schema)

__all__ = ["empty_like", "lookup_table", "parse_json_rescued", "quarantine_split", "read_change_feed",
           "read_json_lines", "read_window", "rescued_keys", "with_lineage",
           "detect_drift", "drift_state", "evolve_schema", "evolve_stored_schema", "infer_json_schema",
           "load_schema", "store_schema"]
