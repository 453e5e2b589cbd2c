"""DataFrame -> DataFrame operators."""

from clickmodel.operators.base import (base_events, ecommerce_repack, flatten_event,
                                       select_source)
from clickmodel.operators.dedup import dedup_events, first_per_group
from clickmodel.operators.items import collect_items, explode_items, normalize_items
from clickmodel.operators.joins import left_join
from clickmodel.operators.params import extract_params, unnest_key, with_params_map
from clickmodel.operators.quality import served_count, unique_violations
from clickmodel.operators.serving import serving_projection
from clickmodel.operators.sessions import (build_sessions, date_window, date_window_exact,
                                           drop_boundary_events, first_event_per_session, session_derived,
                                           session_start, session_traffic)
from clickmodel.operators.staging import (gclid_attribution,
                                          query_param_removal, stage_events, url_parts)
from clickmodel.operators.users import user_snapshot

__all__ = [
    "base_events", "ecommerce_repack", "flatten_event", "select_source", "dedup_events",
    "first_per_group", "collect_items", "explode_items", "normalize_items", "left_join", "extract_params",
    "unnest_key", "with_params_map", "served_count", "unique_violations",
    "serving_projection", "build_sessions", "date_window", "date_window_exact", "drop_boundary_events",
    "first_event_per_session", "session_derived", "session_start", "session_traffic", 
    "gclid_attribution", "query_param_removal", "stage_events",
    "url_parts", "user_snapshot",
]
