"""Parameters shared by the workflow stages."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

# The nine numeric features, in output order.
FEATURES = [
    "danceability", "energy", "loudness", "speechiness", "acousticness",
    "instrumentalness", "liveness", "valence", "tempo",
]

# The columns of the curated item table, in output order.
CURATED_COLUMNS = [
    "id", "name", "popularity", "duration_ms", "explicit", "artists", "id_artists",
    "artist_id_primary", "artist_name_primary",
    "release_date", "release_year",
    "danceability", "energy", "key", "loudness", "mode", "speechiness",
    "acousticness", "instrumentalness", "liveness", "valence", "tempo",
    "time_signature",
    "genre",
]


@dataclass(frozen=True)
class Params:
    """Workflow parameters, the same for every data size.

    Limits (``top_groups``, ``variety_groups``, ``n_queries``, ``text_n_queries``, the ``lookup_*`` and
    ``stratified_*`` counts, ``report_rows``, ``report_features``) accept ``None``: everything.
    """

    group: str = "genre"
    entity: str = "artist_id_primary"
    item: str = "id"
    features: list[str] = field(default_factory=lambda: list(FEATURES))
    seed: int = 42
    # group selection
    group_mode: str = "top_n"          # top_n | top_n_plus_variety
    top_groups: int | None = 10
    variety_groups: int | None = 10
    min_rows: int = 500                # importance and numeric evaluation
    # feature importance
    importance_min_items: int = 50
    importance_min_entities: int = 5
    importance_draws: int = 30_000     # attempts a group of the estimate from drawn pairs
    # numeric KNN evaluation
    k: int = 10
    n_queries: int | None = 150
    # text evaluation
    text_min_rows: int = 30
    text_n_queries: int | None = 100
    text_min_cosine: float = 0.2       # pairs of the text comparison alone
    alpha: float = 0.8
    hash_buckets: int = 4096
    # lookup input
    lookup_top_groups: int | None = 20
    lookup_min_rows: int = 1000
    lookup_per_group: int | None = 40
    stratified_per_group: int | None = 10
    stratified_cap: int | None = 5000
    # reports
    report_rows: int | None = 50
    report_features: int | None = 20
    # numeric evaluation on embedding arrays
    vector_min_rows: int = 100
    vector_n_queries: int | None = 50

    def with_(self, **kw) -> "Params":
        return replace(self, **kw)
