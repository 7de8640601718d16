"""Run parameters in one frozen dataclass (no module-level state)."""

from __future__ import annotations

from dataclasses import dataclass, field

# --- fixed values: constants whose values must match the reference pipeline ---
# minimum ratings per user / per item, train share, number of time windows,
# state length K, discount, cut-offs for ranking, evaluation sample, seed, replay capacity,
# relevance threshold on the [0, 1] reward scale, IPS clip, co-rater minimum,
# win/tie margin of the learning-curve comparison.
MIN_USER_RATINGS = 10
MIN_ITEM_RATINGS = 5
TRAIN_RATIO = 0.8
N_TIME_WINDOWS = 4
STATE_SIZE = 10
GAMMA = 0.99
EVAL_K_VALUES = (5, 10, 20)
EVAL_USER_SAMPLE = 1000
RANDOM_SEED = 42
RELEVANCE_THRESHOLD = 0.6
CLIP_THRESHOLD = 10.0
MIN_CO_RATERS = 3
TOP_N_RECOMMENDATIONS = 20
TOP_N_PAIRS = 15
TOP_N_CONTRIBUTORS = 5
N_CANDIDATES = 2000
REPLAY_CAPACITY = 100_000
TIE_MARGIN = 0.003
RATING_MIN = 0.5
RATING_SPAN = 4.5
# MovieLens genre vocabulary (alphabetical, with the "no genres" marker last).
MOVIELENS_GENRES = (
    "Action", "Adventure", "Animation", "Children", "Comedy",
    "Crime", "Documentary", "Drama", "Fantasy", "Film-Noir",
    "Horror", "IMAX", "Musical", "Mystery", "Romance",
    "Sci-Fi", "Thriller", "War", "Western", "(no genres listed)",
)
# item feature defaults when an item has no statistics
DEFAULT_YEAR = 1990
DEFAULT_AVG_RATING = 3.5
DEFAULT_RATING_STD = 0.5
DEFAULT_POPULARITY = 0.5
# decade buckets of the content vector
YEAR_MIN = 1900
YEAR_MAX = 2030
YEAR_BUCKET = 10
# --- end of fixed values ---


@dataclass(frozen=True)
class Params:
    min_user_ratings: int = MIN_USER_RATINGS
    min_item_ratings: int = MIN_ITEM_RATINGS
    cold_start_iterations: int = 1
    train_ratio: float = TRAIN_RATIO
    n_windows: int = N_TIME_WINDOWS
    state_size: int = STATE_SIZE
    gamma: float = GAMMA
    k_values: tuple[int, ...] = EVAL_K_VALUES
    eval_user_sample: int = EVAL_USER_SAMPLE
    seed: int = RANDOM_SEED
    relevance_threshold: float = RELEVANCE_THRESHOLD
    clip: float = CLIP_THRESHOLD
    min_co_raters: int = MIN_CO_RATERS
    top_n: int = TOP_N_RECOMMENDATIONS
    top_pairs: int = TOP_N_PAIRS
    top_contributors: int = TOP_N_CONTRIBUTORS
    n_candidates: int = N_CANDIDATES
    tie_margin: float = TIE_MARGIN
    genres: tuple[str, ...] = field(default=MOVIELENS_GENRES)
    # rows per user above which the item-pair self-join splits the user
    # into chunks (skew guard); each join task sees at most chunk^2 pairs
    pair_chunk_size: int = 2048
    # constrained backup keeps a' with pi_b(a'|s') >= tau * max pi_b(.|s')
    bcq_threshold: float = 0.3
    # a threshold at which the constraint removes actions on the test binding
    strict_threshold: float = 0.97
    history_cap: int = 50
    sample_size: int = 1000
    replay_capacity: int = REPLAY_CAPACITY
    # users that are given recommendations over all pairs
    target_users: int = 20
    # thresholds under which rows keep falling on the test binding
    core_item: int = 20
    core_user: int = 28
    # approximate quantiles and the share of ranks they may be off by
    probs: tuple[float, ...] = (0.5, 0.99)
    rank_tolerance: float = 0.02
