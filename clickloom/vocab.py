"""Fixed values of the clickstream domain.

They must equal the published data description and job defaults, so they are
listed plainly here and nowhere else.
"""

# Actions by rising business value.
ACTIONS = ["view", "click", "clickout", "like"]

# Places an event can come from.
SUBDOMAINS = ["u2i", "i2i", "catalog", "search", "other"]

# Label of an action as a binary target.
BINARY_LABELS = {"view": 0, "click": 1, "clickout": 1, "like": 1, "added-to-cart": 1}

# Weights for autoencoder histories.
HISTORY_WEIGHTS = {"view": 1.0, "click": 2.0, "clickout": 4.0, "like": 8.0}

# Weights for judging sequence models.
SEQUENCE_WEIGHTS = {"view": 1.0, "click": 2.0, "like": 3.0, "clickout": 4.0}

# Fixed values: (weaker, stronger) action pairs for conversion rates.
CONVERSIONS = [
    ("view", "click"),
    ("view", "clickout"),
    ("view", "like"),
    ("click", "clickout"),
    ("click", "like"),
    ("clickout", "like"),
]

# Key columns on either side of a feature group.
USER_KEYS = ["user_id", "region", "socdem_cluster"]
ITEM_KEYS = ["item_id", "brand_id", "category", "subcategory"]

# Default feature groups.
FEATURE_GROUPS = [
    ("user_id",),
    ("user_id", "item_id"),
    ("user_id", "brand_id"),
    ("user_id", "category"),
    ("item_id",),
    ("brand_id",),
    ("category",),
    ("socdem_cluster", "item_id"),
    ("socdem_cluster", "brand_id"),
    ("socdem_cluster", "category"),
]

# Kinds of scalar target, and the columns of the multiclass one.
SCALAR_KINDS = ("log_target", "sqrt_target", "unproccessed")
MULTICLASS_COLUMNS = ["target_view", "target_clickout", "target_like", "target_click"]

# Event attributes of a training row.
ATTRIBUTES = ["category", "subcategory", "brand_id", "os", "subdomain", "action_type"]

# Features of the tree ranker.
NUMERIC = ["price_mean", "price_mean_item", "user_hist_len", "user_mean_target", "item_popularity", "last_day"]
CATEGORICAL = ["item_id", "category", "subcategory", "brand_id", "os", "subdomain"]

# Fixed value: microseconds in one day.
DAY_US = 86_400_000_000


def counter_columns() -> list[str]:
    """Names of the daily counters: every action by subdomain, plus the action total."""
    return [f"num_{a}_{s}" for a in ACTIONS for s in [*SUBDOMAINS, "all_subdomains"]]
