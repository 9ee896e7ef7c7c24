import os

import pytest
from pyspark.sql import functions as F

from clickloom import session
from clickloom.plans.mart import run_mart


def test_scratch_tables_can_be_dropped(spark):
    kept = session._scratch[:]
    session._scratch.clear()
    df = session.materialize(spark.range(10), "numbers")
    path = session._scratch[0].removeprefix("file://")
    assert df.count() == 10 and os.path.isdir(path)
    assert session.drop_scratch() == 1 and not os.path.exists(path)
    session._scratch.extend(kept)


class Remote:
    """A session on separate executor processes, without a shared folder."""

    def __init__(self, master):
        self.sparkContext = self.conf = self
        self.master = master

    def getCheckpointDir(self):
        return None

    def get(self, key, default):
        return default


def test_executors_elsewhere_need_a_shared_folder():
    for master in ("local-cluster[2,1,1024]", "yarn"):
        with pytest.raises(RuntimeError):
            session.shared_dir(Remote(master))


def test_mart_of_another_vocabulary(spark, tmp_path):
    """Other actions and places, from events to the training set."""
    rows = [
        (n, n % 4, n % 5, "added-to-cart" if n % 3 == 0 else "view", "cart" if n % 2 else "main", "ios", n % 6)
        for n in range(120)
    ]
    events = spark.createDataFrame(
        rows, "event_id int, user_id long, item_id long, action_type string, subdomain string, os string, day int"
    ).withColumn("ts", F.timestamp_seconds(F.col("day") * 86400 + F.col("event_id")))
    users = spark.createDataFrame([(u, 1, 2) for u in range(4)], "user_id long, socdem_cluster int, region int")
    items = spark.createDataFrame(
        [(i, 7, "c", "s", 10.0 + i) for i in range(5)],
        "item_id long, brand_id long, category string, subcategory string, price double",
    )
    made = run_mart(
        events, users, items, str(tmp_path), num_days=3, n_last_days=100,
        groups=[("item_id",)], actions=["view", "added-to-cart"], subdomains=["main", "cart"],
    )
    name = "f_num__item_id__sum_num_added-to-cart_cart_3d"
    assert name in made.columns and not any("click" in c for c in made.columns)
    for r in made.select("day", "item_id", F.col(f"`{name}`").alias("n")).collect():
        seen = [
            x for x in rows
            if x[2] == r["item_id"] and x[3] == "added-to-cart" and x[4] == "cart"
            and r["day"] - 3 <= x[6] <= r["day"] - 1
        ]
        assert (r["n"] or 0) == len(seen)
