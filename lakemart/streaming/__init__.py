from lakemart.streaming.ingest import (append_stream, apply_stream, first_deliveries, json_stream, merge_stream,
                                       rollup_stream, stream_table)

__all__ = ["append_stream", "apply_stream", "first_deliveries", "json_stream", "merge_stream", "rollup_stream", "stream_table"]
