"""Sources and sinks."""

from strata.sources.feeds import load, load_text, log_lines, orders_feed, workflow_texts
from strata.sources.files import read_log_lines, read_numbered_lines, read_raw_csv, read_text_corpus, write_raw_csv
from strata.sources.seed import seed_feed
from strata.sources.tables import ensure_schemas, list_schemas, read_layer, write_layer
from strata.sources.versions import layer_versions, publish_version, stage_version

__all__ = [
    "ensure_schemas",
    "layer_versions",
    "list_schemas",
    "load",
    "load_text",
    "log_lines",
    "orders_feed",
    "publish_version",
    "read_layer",
    "read_log_lines",
    "read_numbered_lines",
    "read_raw_csv",
    "read_text_corpus",
    "seed_feed",
    "stage_version",
    "workflow_texts",
    "write_layer",
    "write_raw_csv",
]
