from siltstone.operators.cdc import latest_per_key, scd1
from siltstone.operators.joins import Measure, enrich, enrich_split, hot_keys, summarize
from siltstone.operators.merge import upsert
from siltstone.operators.quality import drop_failing, metrics, observe, quarantine
from siltstone.operators.typing import cast_columns, project
from siltstone.operators.unify import empty, tag_source, unify

__all__ = [
    "Measure", "cast_columns", "drop_failing", "empty", "enrich", "enrich_split", "hot_keys",
    "latest_per_key", "metrics", "observe", "project", "quarantine", "scd1", "summarize", "tag_source", "unify",
    "upsert",
]
