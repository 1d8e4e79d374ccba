from lakemart.sinks.tables import (analyze, compact, compact_all, load, merge_into, publish,
                                   save_bucketed_table, write_bucketed,
                                   write_json)

__all__ = ["analyze", "compact", "compact_all", "load", "merge_into", "publish", "save_bucketed_table", "write_bucketed", "write_json"]
